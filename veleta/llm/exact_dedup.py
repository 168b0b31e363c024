"""Exact dedup with Patricia-trie owners.

Texts are normalised in the JVM (each white-space run becomes one space) and
cut into partitions by length and content hash. A compressed radix trie takes
the full byte strings; its terminal nodes hold the smallest identifier and the
number of rows.

1. Every input partition first fills a trie of its own, so that a text leaves
   a partition about once however many copies it has there. A trie over its
   memory bound spills its largest subtree: the owners in it are handed on.
2. Owners are shuffled by (hash, length) and sorted by them, so that a trie
   holds only the subtree of the current hash: when the next hash begins, the
   finished subtree is spilled to the output and forgotten. A hot text would
   come here from every input partition, whole, into one task. Texts of more
   than `FAN_IN` rows are therefore merged in a tree: a salt deals their copies
   by input partition, and every step leaves one copy in about `FAN_IN`. Rows
   are counted by (hash, length) first, which shuffles no text.
3. Documents look up the owner of their text. Only texts with several rows
   take part in that join; a hot text is one row on its small side, and where
   these are few (`BROADCAST_OWNERS`) whole documents are not shuffled for it.

Defined results: null text counts as empty, and all empty or blank-only texts
follow the same rule of equality as others; ties keep the smallest
identifier, null identifiers last; repeated rows with the same identifier are
all counted, each is returned, and those that carry the smallest identifier
are kept; an empty table gives an empty result; further columns are ignored
by `owners` and `assign` and kept by `drop_copies`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.shared import keep, small_batches
from veleta.llm.text import packed

#: Bytes of distinct text that one trie may hold before it spills a subtree.
TRIE_BYTES = 48 << 20
#: Copies of one text that a task merges in one step.
FAN_IN = 64
#: Up to so many texts with copies are broadcast to drop them (about 200 bytes each); beyond, they are joined by a shuffle.
BROADCAST_OWNERS = 1 << 17


def normalised(text: Column) -> Column:
    """Each white-space run as one space; only runs that change are rewritten."""
    run = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), run, " ")


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of `a` and `b[at:]`."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at : at + n]:
        return n
    low, high = 0, n  # a[:low] matches, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid
    return low


class Node:
    __slots__ = ("label", "children", "owner", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.rows = label, None, None, 0

    def add(self, owner: int | None, rows: int) -> None:
        if owner is not None and (self.owner is None or owner < self.owner):
            self.owner = owner
        self.rows += rows


class OwnerTrie:
    """Compressed radix trie; the first key byte picks one of 256 top subtrees."""

    def __init__(self) -> None:
        self.top: dict[int, Node] = {}
        self.bytes_in: dict[int, int] = {}
        self.size = 0

    def insert(self, key: bytes, owner: int | None, rows: int = 1) -> None:
        first = key[0]
        node, at, grown = self.top.get(first), 0, 0
        if node is None:
            node = self.top[first] = Node(key)
            grown = len(key)
        else:
            while True:
                n = _shared(node.label, key, at)
                if n < len(node.label):  # split the edge
                    rest = Node(node.label[n:])
                    rest.children, rest.owner, rest.rows = node.children, node.owner, node.rows
                    node.label, node.children, node.owner, node.rows = node.label[:n], {rest.label[0]: rest}, None, 0
                at += n
                if at == len(key):
                    break
                if node.children is None:
                    node.children = {}
                child = node.children.get(key[at])
                if child is None:
                    child = node.children[key[at]] = Node(key[at:])
                    grown, node = len(child.label), child
                    break
                node = child
        node.add(owner, rows)
        if grown:
            grown += 200  # the node itself
            self.bytes_in[first] = self.bytes_in.get(first, 0) + grown
            self.size += grown

    def spill(self, first: int | None = None) -> Iterator[tuple[bytes, int | None, int]]:
        """Take out one subtree, the largest by default, and yield its terminals."""
        if first is None:
            first = max(self.bytes_in, key=self.bytes_in.get)
        self.size -= self.bytes_in.pop(first)
        stack = [(b"", self.top.pop(first))]
        while stack:
            prefix, node = stack.pop()
            key = prefix + node.label
            if node.rows:
                yield key, node.owner, node.rows
            if node.children:
                stack.extend((key, c) for c in node.children.values())

    def spill_all(self) -> Iterator[tuple[bytes, int | None, int]]:
        for first in list(self.top):
            yield from self.spill(first)


_HEAD = 12  # bytes of hash and length before the text
OWNER_FIELDS = "h long, n int, body binary, owner long, n_rows long"
_OWNERS = pa.schema([("h", pa.int64()), ("n", pa.int32()), ("body", pa.binary()), ("owner", pa.int64()), ("n_rows", pa.int64())])
SETTLED_FIELDS = "h long, n int, salt int, body binary, owner long, n_rows long, text_sha256 string"
_SETTLED = pa.schema([*list(_OWNERS)[:2], ("salt", pa.int32()), *list(_OWNERS)[2:], ("text_sha256", pa.string())])


def _key(h: int, n: int, body: bytes) -> bytes:
    return h.to_bytes(8, "big", signed=True) + n.to_bytes(4, "big") + body


def _owner_batches(found: Iterable[tuple[bytes, int | None, int]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for key, owner, n_rows in found:
        rows.append((int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:_HEAD], "big"), key[_HEAD:], owner, n_rows))
        size += len(key)
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OWNERS.types)], schema=_OWNERS)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OWNERS.types)], schema=_OWNERS)


def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners within one input partition."""

    def found() -> Iterator[tuple[bytes, int | None, int]]:
        trie = OwnerTrie()
        for batch in batches:
            h, n, body, owner = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                trie.insert(_key(h[i].as_py(), n[i].as_py(), body[i].as_py()), owner[i].as_py())
                while trie.size > TRIE_BYTES:
                    yield from trie.spill()
        yield from trie.spill_all()

    yield from _owner_batches(found())


def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged owners of rows sorted by (hash, length, salt).

    Texts with a salt go on to the next step; those without are done: they are
    left with their digest instead of their bytes, or left out if they have one row.
    """
    trie, current, rows, size = OwnerTrie(), None, [], 0

    def finished() -> int:
        added = 0
        for key, owner, n_rows in trie.spill_all():
            if current[2] is not None:
                rows.append((*current, key[_HEAD:], owner, n_rows, None))
                added += len(key)
            elif n_rows > 1:
                rows.append((*current, None, owner, n_rows, hashlib.sha256(memoryview(key)[_HEAD:]).hexdigest()))
        return added

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SETTLED.types)], schema=_SETTLED)

    for batch in batches:
        h, n, salt, body, owner, n_rows = (batch.column(i) for i in range(6))
        for i in range(batch.num_rows):
            head = (h[i].as_py(), n[i].as_py(), salt[i].as_py())
            if head != current:
                size += finished()
                current = head
                if len(rows) >= 10_000 or size > 8 << 20:
                    yield out()
                    rows.clear()
                    size = 0
            trie.insert(_key(*head[:2], body[i].as_py()), owner[i].as_py(), n_rows[i].as_py())
    finished()
    if rows:
        yield out()


def _settled(rows: DataFrame) -> DataFrame:
    at = ["h", "n", "salt"]
    return rows.select(*at, "body", "owner", "n_rows").repartition(*at).sortWithinPartitions(*at).mapInArrow(settle, SETTLED_FIELDS)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that several rows share: text_sha256, n_bytes, owner (smallest identifier), n_rows."""
    spark = docs.sparkSession
    small_batches(spark)
    text = docs.select(normalised(F.col(text_col)).alias("t"), F.col(id_col).cast("long").alias("owner"))
    keyed = text.select(F.xxhash64("t").alias("h"), F.octet_length("t").alias("n"), F.col("t").cast("binary").alias("body"), "owner")
    parts = keyed.select("h", "n", F.spark_partition_id().alias("part")).groupBy("h", "n").agg(F.count(F.lit(1)).alias("copies"), F.max("part").alias("part"))
    hot = keep(spark, parts.filter(F.col("copies") > FAN_IN).select("h", "n", "part"), "hot")
    n_hot, last = hot.agg(F.count(F.lit(1)), F.coalesce(F.max("part"), F.lit(0))).first()
    width = -(-(last + 1) // FAN_IN)  # salts of the first step
    local = keyed.mapInArrow(combine, OWNER_FIELDS)
    if width == 1:
        salted = local.withColumn("salt", F.lit(None).cast("int"))
    else:
        names = hot.select("h", "n", F.lit(True).alias("hot"))
        local = local.withColumn("part", F.spark_partition_id()).join(F.broadcast(names) if n_hot <= BROADCAST_OWNERS else names, ["h", "n"], "left")
        salted = local.withColumn("salt", F.when(F.col("hot"), F.col("part") % width).cast("int"))
    found = _settled(salted)
    while width > 1:
        found, width = keep(spark, found, "merged"), -(-width // FAN_IN)
        salt = F.col("salt") % width if width > 1 else F.lit(None)
        found = found.filter("salt is null").unionByName(_settled(found.filter("salt is not null").withColumn("salt", salt.cast("int"))))
    return found.select("text_sha256", F.col("n").alias("n_bytes"), "owner", "n_rows")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the row that stays, the size of its group, and whether it stays itself."""
    text = docs.select(F.col(id_col), normalised(F.col(text_col)).alias("t"))
    keys = text.select(id_col, F.sha2("t", 256).alias("text_sha256"), F.octet_length("t").alias("n_bytes"))
    found = keys.join(owners(docs, id_col, text_col), ["text_sha256", "n_bytes"], "left")
    keep = F.when(F.col("n_rows").isNull(), F.col(id_col)).otherwise(F.col("owner"))
    return found.select(
        id_col,
        keep.alias("keep_id"),
        F.coalesce("n_rows", F.lit(1).cast("long")).alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their own columns, whatever their names."""
    rows = docs.select(packed(docs).alias("r"), F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    keys = rows.select("r", "id", F.sha2("t", 256).alias("text_sha256"), F.octet_length("t").alias("n_bytes"))
    found = keep(docs.sparkSession, owners(docs, id_col, text_col), "owners")
    few = found.limit(BROADCAST_OWNERS + 1).count() <= BROADCAST_OWNERS
    joined = keys.join(F.broadcast(found) if few else found, ["text_sha256", "n_bytes"], "left")
    return joined.filter(F.col("n_rows").isNull() | F.col("id").eqNullSafe(F.col("owner"))).select("r.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
