"""Repair of conversation structure by a rank-convergence parallel Viterbi search.

Every row of a conversation is kept, given another role or deleted, and rows
with an empty text may be inserted, at the least total cost that leaves roles
in a legal order; of equally cheap repairs the one whose edit letters come
first in ASCII is taken. The search is a dynamic program over four states.

Rows are sorted by ranges of (conversation, turn, digest), so that a long
conversation is dealt to many tasks; its part in one task is a chunk. A
conversation that lies inside one task is repaired there. The chunks of the
others start their backward pass from a speculative cost vector, all at once;
fix-up passes rerun the chunks whose vector turned out to differ from the one
of the next chunk by more than a constant, until there is none. With the
stitched costs each chunk tells to which state each state leads (one row of
four states a chunk), and then traces its least edits from its own first state.

Defined results: null roles and texts are one space; rows without a
conversation form one of their own; rows without a turn come first; rows of one
turn are ordered by the SHA-256 of their role and text, so that repeated rows
are adjacent and all but the first of them duplicates; empty texts are blank;
an empty table gives an empty result; further columns are dropped, whatever
their names. Very long conversations and texts are streamed: a task holds one
conversation inside its range and a digest and a byte of each row of those at
its ends. The checksum of a repaired conversation is one chain of bytes: for
one that spans tasks, Spark sorts its rows into one task, which streams them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.llm.shared import keep, small_batches

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 3, 4, 3, 3
#: Faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a given or inserted row leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
LEGAL = ("su", "ua", "au")
#: Least costs of ending a conversation in each state.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
#: Bytes of one conversation that a task holds; a longer one is handed on in pieces.
HOLD = 64 << 20
_SPACE = " \t\n\x0b\x0c\r"
Costs = tuple[int, int, int, int]


def kept_state(initial: int, state: int) -> int | None:
    """Where keeping a row leads, by the place of its role's initial in `INITIALS` (3: another one)."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _moves(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row, in ASCII order but for insertions: letter, cost and next state."""
    initial, fault = code & 3, code >> 2
    stays = TRUNCATED_STAYS * (fault == TRUNCATED)
    found = []
    for state in range(4):
        moves = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            if (to := kept_state(initial, state)) is not None:
                moves.append(("K", stays, to))
            moves.append(("R", REROLE + stays, NEXT[state]))
        found.append(moves)
    return found


MOVES = [_moves(code) for code in range(16)]


def step_back(code: int, after: Costs) -> Costs:
    """Least costs to go before a row, insertions before it included, from those after it."""
    b0, b1, b2, b3 = [min([cost + after[to] for _, cost, to in moves]) for moves in MOVES[code]]
    b2, b3 = min(b2, INSERT + b3), min(b3, INSERT + b2)
    return min(b0, INSERT + b2), min(b1, INSERT + b2), b2, b3


def backward(codes: bytes, end: Costs) -> list[Costs]:
    """Costs to go before each row and, last, after all of them."""
    found = [end]
    for code in reversed(codes):
        found.append(step_back(code, found[-1]))
    found.reverse()
    return found


def normal(costs: Costs) -> Costs:
    """The vector up to a constant."""
    least = min(costs)
    return tuple(c - least for c in costs)


def trace(codes: bytes, costs: list[Costs], state: int, last: bool) -> tuple[list[tuple[int, str, int]], int, int]:
    """The ASCII-least cheapest edits as (row, letter, state after it), the state at the end, and their cost.

    An insertion has the number of the row that it comes before. Only the last
    chunk inserts after its rows.
    """
    edits, spent, i, n = [], 0, 0, len(codes)
    while i < n or last and costs[n][state]:
        here = costs[i][state]
        moves = MOVES[codes[i]][state] if i < n else []
        insertion = ("I", INSERT, NEXT[state])
        for letter, cost, to in [*moves[:1], insertion, *moves[1:]]:
            if here == cost + costs[i + (letter != "I")][to]:
                break
        edits.append((i, letter, to))
        spent, state = spent + cost, to
        i += letter != "I"
    return edits, state, spent


def code_of(role: str, fault: int) -> int:
    return (INITIALS.find(role[:1]) if role[:1] and role[0] in INITIALS else 3) | fault << 2


def fault_of(text: str, seen_before: bool) -> int:
    spoken = text.rstrip(_SPACE)
    if not spoken:
        return BLANK
    if seen_before:
        return DUPLICATE
    return SOUND if spoken[-1] in ".!?" else TRUNCATED


_RECORD = {
    "kind": ("string", pa.string()),
    "key": ("string", pa.string()),
    "part": ("int", pa.int32()),
    "place": ("long", pa.int64()),
    "seq": ("int", pa.int32()),
    "edit": ("string", pa.string()),
    "role": ("string", pa.string()),
    "text": ("string", pa.string()),
    "fault": ("int", pa.int32()),
    "digest": ("binary", pa.binary()),
    "codes": ("binary", pa.binary()),
    "first_turn": ("long", pa.int64()),
    "last_turn": ("long", pa.int64()),
    "first_role": ("string", pa.string()),
    "last_role": ("string", pa.string()),
    "turns": ("long", pa.int64()),
    "least_turn": ("long", pa.int64()),
    "illegal": ("long", pa.int64()),
    "audit": ("string", pa.string()),
    "cost": ("long", pa.int64()),
    "sha256": ("string", pa.string()),
}
_SCHEMA = pa.schema([(name, kind) for name, (_, kind) in _RECORD.items()])


class _Chunk:
    """The part of a conversation in one task, row by row."""

    def __init__(self, key: str, part: int, is_open: bool):
        self.key, self.part, self.open = key, part, is_open
        self.codes, self.seen, self.held, self.size = bytearray(), set(), [], 0
        self.first_turn = self.last_turn = self.least_turn = self.first_role = None
        self.last_role, self.turns, self.illegal = "", 0, 0

    def add(self, turn: int | None, role: str, text: str, digest: bytes) -> Iterator[dict]:
        fault = fault_of(text, digest in self.seen)
        self.seen.add(digest)
        if not self.codes:
            self.first_turn, self.first_role = turn, role[:1]
        else:
            self.illegal += self.last_role + role[:1] not in LEGAL
        if turn is not None:
            self.turns += turn != self.last_turn or not self.turns
            self.least_turn = turn if self.least_turn is None else self.least_turn
        self.last_turn, self.last_role = turn, role[:1]
        row = {"key": self.key, "part": self.part, "place": len(self.codes), "role": role, "text": text, "fault": fault, "digest": digest}
        self.codes.append(code_of(role, fault))
        self.held.append(row)
        self.size += len(text)
        if self.open or self.size > HOLD:
            yield from self.hand_on()

    def hand_on(self) -> Iterator[dict]:
        """The rows as they are, of a conversation that may go on in another task."""
        self.open = True
        for row in self.held:
            yield {"kind": "open", **row}
        self.held = []

    def end(self, at_edge: bool) -> Iterator[dict]:
        """What is left of the chunk: its repaired rows where it is a whole conversation; then the chunk itself."""
        names = ("key", "part", "first_turn", "last_turn", "first_role", "last_role", "turns", "least_turn", "illegal")
        chunk = {name: getattr(self, name) for name in names} | {"codes": bytes(self.codes)}
        if self.open or at_edge:
            yield from self.hand_on()
            yield {"kind": "open chunk", **chunk}
            return
        edits, _, cost = trace(self.codes, backward(self.codes, END), START, True)
        checksum, first = sha256(), True
        for seq, (i, letter, to) in enumerate(edits):
            row = self.held[i] if letter != "I" else {"key": self.key, "part": self.part, "place": i, "text": ""}
            role = row["role"] if letter in "DK" else ROLES[to]
            yield {"kind": "row", **row, "seq": seq, "edit": letter, "role": role}
            if letter != "D":
                checksum.update(f"{'' if first else '\n'}{role}:{row['text']}".encode())
                first = False
        audit = "".join([letter for _, letter, _ in edits])
        yield {"kind": "chunk", **chunk, "audit": audit, "cost": cost, "sha256": checksum.hexdigest()}


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to repaired ones where the conversation is all here, else to open ones; and chunks."""
    part, chunk, out, size = TaskContext.get().partitionId(), None, [], 0
    for batch in batches:
        for key, turn, role, text, digest in zip(*[c.to_pylist() for c in batch.columns]):
            if chunk is None or key != chunk.key:
                if chunk is not None:
                    out.extend(chunk.end(False))
                chunk = _Chunk(key, part, chunk is None)  # the first one may have begun in another task
            out.extend(chunk.add(turn, role, text, digest))
            size += len(text) + 100
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                out, size = [], 0
    if chunk is not None:
        out.extend(chunk.end(True))
    yield pa.RecordBatch.from_pylist(out, _SCHEMA)


def _codes(chunk: dict) -> bytes:
    """A chunk's codes, with duplicates of earlier chunks as such."""
    codes = bytearray(chunk["codes"])
    for i in chunk["late"] or ():
        codes[i] = codes[i] & 3 | DUPLICATE << 2
    return bytes(codes)


def _by_chunk(function, schema: pa.Schema):
    """mapInArrow function of a chunk's row to another row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist([function(batch.slice(i, 1).to_pylist()[0])], schema)

    return run


def _back(chunk: dict) -> dict:
    costs = backward(_codes(chunk), tuple(chunk["end"]))
    return {"key": chunk["key"], "part": chunk["part"], "end": chunk["end"], "start": normal(costs[0])}


def _leads(chunk: dict) -> dict:
    codes = _codes(chunk)
    costs = backward(codes, tuple(chunk["end"]))
    to = [trace(codes, costs, state, False)[1] for state in range(4)]
    turns = {c: None if chunk[c] is None else str(chunk[c]) for c in ("first_turn", "last_turn")}
    return {c: chunk[c] for c in ("key", "part", "first_role", "last_role")} | turns | {"leads": to}


def _traced(chunk: dict) -> dict:
    codes = _codes(chunk)
    edits, _, cost = trace(codes, backward(codes, tuple(chunk["end"])), chunk["state"], chunk["last"])
    made = [{"place": i, "seq": n, "edit": letter, "given": None if letter in "DK" else ROLES[to]} for n, (i, letter, to) in enumerate(edits)]
    return {"key": chunk["key"], "part": chunk["part"], "codes": codes, "cost": cost, "audit": "".join([e["edit"] for e in made]), "edits": made}


_VECTOR = pa.list_(pa.int64())
_BACK = pa.schema([("key", pa.string()), ("part", pa.int32()), ("end", _VECTOR), ("start", _VECTOR)])
_EDITS = pa.list_(pa.struct([("place", pa.int64()), ("seq", pa.int32()), ("edit", pa.string()), ("given", pa.string())]))
_TRACED = pa.schema([("key", pa.string()), ("part", pa.int32()), ("codes", pa.binary()), ("cost", pa.int64()), ("audit", pa.string()), ("edits", _EDITS)])
_LEADS = pa.schema(
    [("key", pa.string()), ("part", pa.int32()), *[(c, pa.string()) for c in ("first_turn", "last_turn", "first_role", "last_role")], ("leads", _VECTOR)]
)


def _states(chunks: pd.DataFrame) -> pd.DataFrame:
    """The first state of each chunk of a conversation, and what lies between it and the one before; a row a chunk."""
    state, before, found = START, None, []
    rows = list(chunks.sort_values("part").itertuples())
    for n, c in enumerate(rows):
        joined = before is not None
        illegal = joined and before.last_role + c.first_role not in LEGAL
        repeated = joined and c.first_turn is not None and before.last_turn == c.first_turn
        found.append((c.key, c.part, state, n + 1 == len(rows), int(illegal), int(repeated)))
        state, before = int(c.leads[state]), c
    return pd.DataFrame(found, columns=["key", "part", "state", "last", "between", "repeated"])


def converge(spark: SparkSession, chunks: DataFrame) -> DataFrame:
    """key, part and `end`, the costs after each chunk up to a constant: speculative ones, fixed up until all fit.

    A pass reruns the chunks that started from another vector than the chunk
    after them arrived at; at most as many passes as a conversation has chunks.
    """
    to_array = lambda costs: F.array(*[F.lit(c).cast("long") for c in costs])
    back, schema = _by_chunk(_back, _BACK), "key string, part int, end array<long>, start array<long>"
    vectors = keep(spark, chunks.withColumn("end", to_array(END)).mapInArrow(back, schema), "speculative")
    while True:
        after = F.lead("start").over(W.partitionBy("key").orderBy("part"))  # one row a chunk
        told = vectors.withColumn("want", F.coalesce(after, to_array(END)))
        stale = told.filter("want <> end").select("key", "part", F.col("want").alias("end"))
        if not stale.limit(1).count():
            return vectors.select("key", "part", "end")
        redone = chunks.join(stale, ["key", "part"]).mapInArrow(back, schema)
        vectors = keep(spark, told.filter("want = end").drop("want").unionByName(redone), "fixed")


def _stitched(spark: SparkSession, settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and chunks of the conversations that lie in several tasks."""
    rows = settled.filter("kind = 'open'").select("key", "part", "place", "role", "text", "fault", "digest")
    # of equal rows in several chunks the one in the first chunk comes first; in a chunk they are marked already
    firsts = rows.filter(F.col("fault").isin(SOUND, TRUNCATED)).select("key", "digest", "part", "place")
    least = firsts.groupBy("key", "digest").agg(F.min("part").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    late = firsts.join(least, ["key", "digest"]).filter("part > least").groupBy("key", "part").agg(F.collect_list("place").alias("late"))
    names = ("key", "part", "codes", "first_turn", "last_turn", "first_role", "last_role", "turns", "least_turn", "illegal")
    chunks = keep(spark, settled.filter("kind = 'open chunk'").select(*names).join(late, ["key", "part"], "left"), "chunks")
    ends = converge(spark, chunks)
    known = chunks.join(ends, ["key", "part"])
    leads = known.mapInArrow(_by_chunk(_leads, _LEADS), "key string, part int, first_turn string, last_turn string, first_role string, last_role string, leads array<long>")
    states = leads.groupBy("key").applyInPandas(_states, "key string, part int, state int, last boolean, between long, repeated long")
    states = keep(spark, states, "states")
    edits = "array<struct<place: long, seq: int, edit: string, given: string>>"
    traced = known.join(states, ["key", "part"]).mapInArrow(_by_chunk(_traced, _TRACED), f"key string, part int, codes binary, cost long, audit string, edits {edits}")
    traced = keep(spark, traced, "traced")
    each = traced.select("key", "part", F.explode("edits").alias("e")).select("key", "part", "e.*")
    given = rows.select("key", "part", "place", "role", "text").withColumn("is_row", F.lit(True))
    joined = each.withColumn("is_row", F.col("edit") != "I").join(given, ["key", "part", "place", "is_row"], "left")
    repaired = joined.select("key", "part", "place", "seq", "edit", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = chunks.drop("codes", "late").join(traced.drop("edits"), ["key", "part"]).join(states, ["key", "part"])
    told = told.withColumns({"illegal": F.col("illegal") + F.col("between"), "turns": F.col("turns") - F.col("repeated")})
    return repaired, told.drop("state", "last", "between", "repeated", "first_role", "last_role", "first_turn")


def checksums(repaired: DataFrame) -> DataFrame:
    """key and `sha256` of the repaired rows, `role:text` joined by line ends: sorted by Spark, streamed by a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            for k, edit, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if running is None or k != key:
                    if running is not None:
                        yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [running.hexdigest()]})
                    key, running, first = k, sha256(), True
                if edit != "D":
                    running.update(f"{'' if first else '\n'}{role}:{text}".encode())
                    first = False
        if running is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [running.hexdigest()]})

    order = repaired.repartition("key").sortWithinPartitions("key", "part", "seq")
    return order.select("key", "edit", "role", "text").mapInArrow(run, "key string, sha256 string")


def _faults(codes: bytes) -> dict:
    faults = [c >> 2 for c in codes]
    return {"blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED)}


def _counts(chunks: DataFrame) -> DataFrame:
    """Chunks with their numbers of faults in place of the codes."""
    schema = pa.schema([("key", pa.string()), ("part", pa.int32()), *[(f, pa.int64()) for f in ("blank", "duplicate", "truncated")]])
    of = _by_chunk(lambda c: {"key": c["key"], "part": c["part"]} | _faults(c["codes"]), schema)
    return chunks.select("key", "part", "codes").mapInArrow(of, "key string, part int, blank long, duplicate long, truncated long")


def ordered(rows: DataFrame) -> DataFrame:
    """key, turn, role, text and digest, sorted by ranges; equal rows are told apart, so that no range must hold them all."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(conversation_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    told = plain.withColumns({"digest": digest, "nth": F.monotonically_increasing_id()})
    order = ["key", F.asc_nulls_first("turn"), "digest", "nth"]
    return told.repartitionByRange(*order).sortWithinPartitions(*order).drop("nth")


def conversation_key(conv_id):
    """A text for each conversation, the one without an identifier included."""
    return F.when(conv_id.isNull(), "none").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def repair(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and one summary row for each conversation, of the columns conv_id, turn, role and text.

    Rows: key, part, place, seq, edit, role, text (ordered by part and seq;
    deleted ones have edit D). Summary: key, gaps, blank, duplicate, truncated,
    illegal, cost, audit and sha256 of what stays.
    """
    small_batches(spark)
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in _RECORD.items())
    settled = keep(spark, ordered(rows).mapInArrow(_settle, schema), "settled")
    open_rows, open_chunks = _stitched(spark, settled)
    open_rows = keep(spark, open_rows, "open-rows")
    names = ("key", "part", "codes", "turns", "least_turn", "last_turn", "illegal", "audit", "cost")
    closed = settled.filter("kind = 'chunk'").select(*names, "sha256")
    chunks = keep(spark, closed.unionByName(open_chunks.select(*names), allowMissingColumns=True), "all-chunks")
    told = chunks.drop("codes").join(_counts(chunks), ["key", "part"])
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audits = F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"])  # one a chunk
    summary = told.groupBy("key").agg(
        F.coalesce(F.max("last_turn") - F.min("least_turn") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
        *sums,
        F.array_join(audits, "").alias("audit"),
        F.max("sha256").alias("whole"),
    )
    stitched = checksums(open_rows)
    summary = summary.join(stitched, "key", "left").withColumn("sha256", F.coalesce("whole", "sha256")).drop("whole")
    return settled.filter("kind = 'row'").select(*open_rows.columns).unionByName(open_rows), summary


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with one of the faults that a repair must find: by the checksum of conversation and turn, a twentieth each.

    0 drops the row, 1 empties its text, 2 takes the ends of its sentences, 3
    repeats it, 4 makes it the user's. Nulls are one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    which = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    hit = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), which.alias("which")).filter("which <> 0")
    return hit.select(
        "conv_id",
        "turn",
        F.when(F.col("which") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("which") == 1, "").when(F.col("which") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("which") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One row for each conversation of `rows`: what is wrong after damage, and its cheapest repair."""
    _, summary = repair(spark, damaged(rows))
    every = rows.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(summary, "key", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
