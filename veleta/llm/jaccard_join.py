"""N-gram Jaccard join by grouped prefixes.

Two documents link when their sets of distinct five-word shingles have a
Jaccard similarity of at least `PERCENT`. Sets are ordered the same way
everywhere, so that linked sets share a shingle among the first few of each
(the prefix), and:

1. Documents with the same set are one member; members with the same prefix
   and set size are one group, and only groups are joined. Equal sets are told
   by their size and two 64-bit digests over two different hashes of their
   shingles.
2. Groups meet in the postings of prefix shingles. Sizes and places of the
   shared shingle filter group pairs.
3. Pairs that pass are expanded to members and verified on the whole texts,
   word for word: each member with its nearest candidate first, then the pairs
   that could still join two components.

Frequent shingles come last in the order, the most frequent ones at the very
end, which keeps postings short. Which ones are frequent is counted over all
documents; the list that is sent to the tasks is bounded (`MOST_HOT`), and any
list gives the same links.

A posting that is long all the same belongs to near copies of one text. Only
components are asked for, so each group first meets a few pivots of its
postings; after that, pairs inside one component are settled, and every other
pair of the posting with a possible size is tried, in blocks of at most
`BLOCK` rows, so that a hot posting is many tasks. No pair that could join two
components is left out; what stays quadratic is the number of pairs of one
posting, of similar size, that no component settles and no sketch rules out. A
parity sketch of each set bounds the difference of two sets from below and
spares most verifications that would fail.

Defined results: null, empty or blank text has an empty set and links with
nothing; a text of fewer than five words has one shingle, the whole sequence;
ties take the smallest identifier; rows are told apart by a key of their own,
so a null identifier links like any other (but names no component), and
repeated rows with one identifier are each returned: an identifier with several
texts stands for all of them, and what links with one of them is in its
component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm.components import components
from veleta.llm.shared import forget, keep, small_batches
from veleta.llm.shingles import double_hash_sets, firsts, hash_sets, mix, word_shingles

PERCENT = 80
#: A shingle in the first part of more documents than this counts as frequent.
HOT_ABOVE = 64
#: Postings of more groups than this go through pivots.
LONG_ABOVE = 16
PIVOTS = 16
#: Rows of a long posting that meet each other group in one task.
BLOCK = 4096
#: 64-bit words of a parity sketch.
SKETCH = 8
#: Words of the wide sketch of documents that are in a candidate pair.
WIDE_SKETCH = 128
#: At most so many frequent shingles, the most frequent ones, are sent to the tasks (5 bytes each).
MOST_HOT = 1 << 20
#: Up to so many identifiers are broadcast to pick documents; beyond, they are joined by shuffle.
BROADCAST_IDS = 1 << 21


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    """Linked sets of n and at most n shingles share one of the first so many."""
    return n - (-(-PERCENT * n // 100)) + 1


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sliced(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, sorted, of the most frequent shingles among the first part of each set, and their classes of frequency.

    A fingerprint is the upper half of a hash; two shingles that share one are
    ordered alike, which no link depends on.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            part = [h[: 5 * prefix_length(len(h)) // 4] >> np.uint64(32) for h in hash_sets(_texts(batch, 0))]
            part = [p[firsts(p)] for p in part]  # sorted, as the hashes are
            if sum(map(len, part)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part).astype(np.uint32).view(np.int32))], names=["s"])

    counts = docs.select("text").mapInArrow(run, "s int").groupBy("s").count().filter(F.col("count") > HOT_ABOVE)
    kind = F.log2(F.col("count")).cast("tinyint").alias("kind")
    top = counts.orderBy(F.desc("count"), "s").limit(MOST_HOT).select("s", kind).toPandas()
    s = top["s"].to_numpy(np.int32).view(np.uint32)
    order = np.argsort(s)
    return s[order], top["kind"].to_numpy(np.int8)[order]


def _folds(sets: list[np.ndarray], seed: int) -> pa.Array:
    """A hash of each set, whatever its order."""
    ends = np.cumsum([0, *map(len, sets)])
    upto = np.zeros(ends[-1] + 1, np.uint64)
    if ends[-1]:
        np.bitwise_xor.accumulate(mix(np.concatenate(sets) + np.uint64(seed)), out=upto[1:])
    found = upto[ends]
    return pa.array((found[1:] ^ found[:-1] ^ np.uint64(seed)).view(np.int64))


_SKETCH = [f"q{i}" for i in range(SKETCH)]
#: What tells sets apart: size and two digests.
_SET = ["n", "s1", "s2"]
KEY_FIELDS = "row long, doc long, n long, g1 long, g2 long, s1 long, s2 long, " + ", ".join(f"{q} long" for q in _SKETCH) + ", prefix array<long>"
_KEY_NAMES = [f.split()[0] for f in KEY_FIELDS.split(", ")]


def _sketch(h: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """Bit b is the parity of the members that hash to b."""
    odd = (np.bincount((h & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _numbers(found: list[int]) -> pa.Array:
    return pa.array(np.array(found, np.int64))


def keyed(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Set size, hashes of prefix and set, and the prefix itself, of every row (row, doc, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, kind = shared.value
        for batch in _sliced(batches):
            both, prefixes = list(double_hash_sets(_texts(batch, 2))), []
            for h, _ in both:
                if len(hot) and len(h):
                    upper = (h >> np.uint64(32)).astype(np.uint32)
                    at = np.minimum(np.searchsorted(hot, upper), len(hot) - 1)
                    late = np.where(hot[at] == upper, kind[at], 0)
                    if late.any():
                        h = h[np.argsort(late, kind="stable")]
                prefixes.append(h[: prefix_length(len(h))] if len(h) else h)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    _numbers([len(h) for h, _ in both]),
                    *(_folds(prefixes, seed) for seed in (1, 2)),
                    _folds([h for h, _ in both], 3),
                    _folds([h for _, h in both], 4),
                    *(pa.array(q) for q in np.stack([_sketch(h) for h, _ in both]).T.copy()),
                    _lists(prefixes),
                ],
                names=_KEY_NAMES,
            )

    return docs.select("row", "doc", "text").mapInArrow(run, KEY_FIELDS)


def _can_link(n1: Column, n2: Column) -> Column:
    return (100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2))


def _places_allow(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Whether enough shingles follow the first shared one, at these places of the prefixes."""
    most = F.least(n1 - p1, n2 - p2)
    return (100 + PERCENT) * most >= PERCENT * (n1 + n2)


def _bits_apart(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}{q}").bitwiseXOR(F.col(f"{b}{q}"))) for q in _SKETCH), F.lit(0))


def _sketches_allow(n1: Column, n2: Column, a: str, b: str) -> Column:
    """Whether the sets can be similar: they differ in at least as many members as their sketches in bits."""
    return (100 + PERCENT) * _bits_apart(a, b) <= (100 - PERCENT) * (n1 + n2)


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _of_pairs(docs: DataFrame, pairs: DataFrame, members: DataFrame, made, kind: str, repeated: bool) -> DataFrame:
    """doc, set and `made` (text, hashes -> value; kind: its Spark type) for the members of the pairs.

    A member is found again by its identifier, and by its set should the identifier have several.
    """
    spark = docs.sparkSession
    rows = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row"))).distinct()
    ids = keep(spark, members.select("row", F.col("doc").alias("own")).join(rows, "row", "left_semi").select("own").distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    picked = docs.join(F.broadcast(ids) if few else ids, F.col("doc").eqNullSafe(F.col("own")), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            texts = _texts(batch, 1)
            both = list(double_hash_sets(texts))
            values = [made(t, h) for t, (h, _) in zip(texts, both)]
            columns = [batch.column(0), _numbers([len(h) for h, _ in both]), _folds([h for h, _ in both], 3), _folds([h for _, h in both], 4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary()) if kind == "binary" else _lists(values)], names=["doc", *_SET, "made"])

    found = picked.mapInArrow(run, f"doc long, n long, s1 long, s2 long, made {kind}")
    made_of = keep(spark, found.dropDuplicates(["doc", *_SET]) if repeated else found, "sets")
    forget(spark, ids)
    return made_of


def _joined_pairs(pairs: DataFrame, members: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs with nu, nv, and what was made of both members, mu and mv."""
    for x in "uv":
        key = members.select(F.col("row").alias(x), *[F.col(c).alias(f"{c}{x}") for c in ("doc", *_SET)])
        value = of.select(F.col("made").alias(f"m{x}"), *[F.col(c).alias(f"of_{c}") for c in ("doc", *_SET)])
        same = F.col("of_doc").eqNullSafe(F.col(f"doc{x}"))
        for c in _SET:
            same = same & (F.col(f"of_{c}") == F.col(f"{c}{x}"))
        pairs = pairs.join(key, x).join(value, same).drop("of_doc", *[f"of_{c}" for c in _SET], f"doc{x}", f"s1{x}", f"s2{x}")
    return pairs


def _link_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those pairs (u, v, text, text) whose sets of shingles, word for word, are similar enough."""
    last: dict[bytes, set] = {}

    def shingles(text: bytes) -> set:
        found = last.get(text)
        if found is None:
            if len(last) >= 4:
                last.pop(next(iter(last)))
            found = last[text] = word_shingles(text)
        return found

    for batch in _sliced(batches, 256):
        ok = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = shingles(a), shingles(b)
            both = len(x & y)
            ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def verified(docs: DataFrame, pairs: DataFrame, members: DataFrame, repeated: bool, sketched: bool = True) -> DataFrame:
    """Those pairs (u, v) of members whose whole texts are similar enough.

    Wide sketches, a kilobyte a document, sort out most pairs first (unless most
    will be links), so that whole texts travel for little more than the links
    themselves.
    """
    spark = docs.sparkSession
    hopeful = _hopeful(docs, pairs, members, repeated) if sketched else pairs
    texts = _of_pairs(docs, hopeful, members, lambda t, _: t, "binary", repeated)
    both = _joined_pairs(hopeful, members, texts).select("u", "v", "mu", "mv")
    links = keep(spark, both.mapInArrow(_link_batches, "u long, v long"), "links")
    forget(spark, texts, *([hopeful] if sketched else []))
    return links


def _hopeful(docs: DataFrame, pairs: DataFrame, members: DataFrame, repeated: bool) -> DataFrame:
    """Pairs whose wide sketches allow a link."""
    spark = docs.sparkSession
    sketches = _of_pairs(docs, pairs, members, lambda _, h: _sketch(h, WIDE_SKETCH).view(np.uint64), "array<long>", repeated)
    wide = _joined_pairs(pairs, members, sketches)
    differ = F.aggregate(F.zip_with("mu", "mv", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    hopeful = wide.filter((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("nu") + F.col("nv"))).select("u", "v")
    hopeful = keep(spark, hopeful, "hopeful")
    forget(spark, sketches)
    return hopeful


def _met(a: DataFrame, b: DataFrame, also: Column) -> DataFrame:
    """Pairs of groups that meet in a posting and pass the filters of size and place."""
    n1, n2 = F.col("a.n"), F.col("b.n")
    fits = _can_link(n1, n2) & _places_allow(n1, F.col("a.place"), n2, F.col("b.place"))
    return a.join(b, (F.col("a.s") == F.col("b.s")) & also & fits).select(*_pairs(F.col("a.gid"), F.col("b.gid")))


def _met_in_blocks(loose: DataFrame, rows: DataFrame, also: Column) -> DataFrame:
    """The same for long postings: only neighbouring classes of size meet, and at most BLOCK rows with each group in one task."""
    # sizes of linked sets differ by a quarter at most, which is less than a class
    size = F.floor(F.log("n") / F.log(F.lit(1.3)))
    b = rows.withColumn("size", size)
    blocks = b.groupBy("s", "size").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    b = b.join(blocks, ["s", "size"]).withColumn("block", F.pmod(F.xxhash64("gid"), "blocks").cast("int"))
    a = loose.withColumn("size", F.explode(F.array(size - 1, size, size + 1))).join(blocks, ["s", "size"])
    a = a.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return _met(a.alias("a"), b.alias("b"), also & (F.col("a.size") == F.col("b.size")) & (F.col("a.block") == F.col("b.block")))


def _promising(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of members whose sizes and sketches allow a link, and in how many bits the sketches differ."""
    a = sketches.select(F.col("row").alias("u"), F.col("n").alias("an"), *[F.col(q).alias(f"a{q}") for q in _SKETCH])
    b = sketches.select(F.col("row").alias("v"), F.col("n").alias("bn"), *[F.col(q).alias(f"b{q}") for q in _SKETCH])
    allowed = _can_link(F.col("an"), F.col("bn")) & _sketches_allow(F.col("an"), F.col("bn"), "a", "b")
    return pairs.join(a, "u").join(b, "v").filter(allowed).select("u", "v", _bits_apart("a", "b").alias("apart"))


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs whose members are not in one component (vertex, component)."""
    for x in "uv":
        pairs = pairs.join(parts.select(F.col("vertex").alias(x), F.col("component").alias(f"c{x}")), x, "left")
    return pairs.filter(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")


def _linked(spark: SparkSession, docs: DataFrame, tried: DataFrame, known: DataFrame, members: DataFrame, repeated: bool) -> tuple[DataFrame, DataFrame]:
    """Links that give the same components as all links among `tried` and `known`, and those components.

    Each member is compared with its nearest candidate first; after that only
    pairs that would join two components are left, so that the texts of near
    copies travel about once and not with every copy.
    """
    nearest = keep(spark, tried.groupBy("v").agg(F.min_by("u", F.struct("apart", "u")).alias("u")).select("u", "v"), "nearest")
    first = verified(docs, nearest, members, repeated, False)
    links = keep(spark, first.unionByName(known), "links")
    parts = components(spark, links)
    rest = keep(spark, _apart(tried.select("u", "v"), parts), "apart")
    if not rest.limit(1).count():
        forget(spark, nearest, first, rest)
        return links, parts
    second = verified(docs, rest, members, repeated)
    both = keep(spark, links.unionByName(second), "links")
    forget(spark, nearest, first, links, rest, second)
    return both, components(spark, both)


def _same_identifier(keys: DataFrame, members: DataFrame) -> tuple[DataFrame, bool]:
    """Edges between members that share an identifier, and whether any row repeats identifier and set."""
    sets = keys.filter("n > 0 and doc is not null").groupBy("doc", *_SET).agg(F.count(F.lit(1)).alias("times"))
    by_doc = sets.groupBy("doc").agg(F.count(F.lit(1)).alias("sets"), F.max("times").alias("times"))
    several = keep(keys.sparkSession, by_doc.filter("sets > 1 or times > 1"), "several")
    nameless = keys.filter("n > 0 and doc is null").limit(1).count() > 0  # these can repeat too
    repeated = nameless or several.filter("times > 1").limit(1).count() > 0
    named = sets.join(several.filter("sets > 1").select("doc"), "doc").join(members.select("row", *_SET), _SET).select("doc", "row")
    first = named.groupBy("doc").agg(F.min("row").alias("first"))
    return named.join(first, "doc").filter("row <> first").select(*_pairs(F.col("row"), F.col("first"))), repeated


def link_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id for every document."""
    small_batches(spark)
    base = _base(docs, id_col, text_col)
    keys = keep(spark, keyed(base.withColumn("row", F.monotonically_increasing_id()), frequent_shingles(base)), "keys")
    # members: one row of each distinct set; groups: one member of each (size, prefix)
    one_row = F.min(F.struct("row", "doc"))
    members = keys.filter("n > 0").groupBy("n", "g1", "g2", "s1", "s2").agg(one_row.alias("r"), F.min("doc").alias("least"), *[F.min(q).alias(q) for q in _SKETCH])
    members = keep(spark, members.select("r.row", "r.doc", "least", "n", "g1", "g2", "s1", "s2", *_SKETCH), "members")
    same_id, repeated = _same_identifier(keys, members)
    leaders = members.groupBy("n", "g1", "g2").agg(F.min("row").alias("gid"), (F.count(F.lit(1)) > 1).alias("many"))
    grouped = keep(spark, members.join(leaders, ["n", "g1", "g2"]).select("gid", "many", "row", "n"), "grouped")
    sketches = members.select("row", "n", *_SKETCH)
    heads = keep(spark, grouped.filter("gid = row").select("row"), "heads")
    if heads.count() <= BROADCAST_IDS:
        by_group = keys.select("row", "n", "prefix").join(F.broadcast(heads), "row", "left_semi")
    else:  # prefixes are dealt out once, and read twice
        by_group = keep(spark, keys.select("row", "n", "prefix").join(heads, "row", "left_semi"), "prefixes")
    postings = by_group.select(F.col("row").alias("gid"), F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("place", "s"))
    shared = postings.groupBy("s").agg(F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    lists = keep(spark, postings.join(shared, "s"), "lists")
    forget(spark, heads)

    # every pair of a short posting; in a long one, every group and the pivots
    short = lists.filter(F.col("groups") <= LONG_ABOVE)
    met = _met(short.alias("a"), short.alias("b"), F.col("a.gid") < F.col("b.gid"))
    long = lists.filter(F.col("groups") > LONG_ABOVE)
    least = [F.min(F.struct(F.xxhash64("gid", F.lit(k)).alias("h"), "gid"))["gid"] for k in range(PIVOTS)]
    pivots = keep(spark, long.groupBy("s").agg(F.array_distinct(F.array(*least)).alias("pivots")), "pivots")
    seen = long.join(pivots, "s").groupBy("gid").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
    stars = seen.select("gid", F.explode("pivots").alias("pivot")).filter("gid <> pivot").select(*_pairs(F.col("gid"), F.col("pivot")))
    inner = grouped.filter("gid <> row").select(*_pairs(F.col("gid"), F.col("row")))
    tried = keep(spark, _promising(met.unionByName(stars).unionByName(inner).distinct(), sketches), "tried")
    links, parts = _linked(spark, base, tried, same_id, members, repeated)
    so_far = parts.withColumnRenamed("vertex", "row")

    # what is not settled by that: pairs of one posting or group whose members are not all in one component
    placed = grouped.join(so_far, "row", "left").select("gid", "many", "row", F.coalesce("component", "row").alias("c"))
    placed = keep(spark, placed, "placed")
    spans = placed.groupBy("gid").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.first("many").alias("many"))
    at_pivots = pivots.select("s", F.explode("pivots").alias("gid")).join(spans, "gid")
    main = at_pivots.groupBy("s").agg(F.mode("c1", True).alias("main"))
    loose = (F.col("c1") != F.col("main")) | (F.col("c2") != F.col("main"))
    rows = long.join(spans, "gid").join(main, "s")
    open_ = rows.filter(loose).select("s").distinct()
    rows = keep(spark, rows.join(open_, "s", "left_semi").join(sketches.drop("n").withColumnRenamed("row", "gid"), "gid"), "open")
    settled = (F.col("a.c1") == F.col("a.c2")) & (F.col("b.c1") == F.col("b.c2")) & (F.col("a.c1") == F.col("b.c1"))
    hopeful = F.col("a.many") | F.col("b.many") | _sketches_allow(F.col("a.n"), F.col("b.n"), "a.", "b.")
    late = _met_in_blocks(rows.filter(loose), rows, (F.col("a.gid") != F.col("b.gid")) & ~settled & hopeful)
    # groups of several members: those of a short posting have met by their leaders only
    several = met.join(spans.filter("many").select(F.col("gid").alias("u")), "u", "left_semi").unionByName(
        met.join(spans.filter("many").select(F.col("gid").alias("v")), "v", "left_semi").select("u", "v")
    )
    mixed = spans.filter("c1 <> c2").select(F.col("gid").alias("u"), F.col("gid").alias("v"))
    group_pairs = late.unionByName(several).unionByName(mixed).distinct()
    one = placed.select(F.col("gid").alias("u"), F.col("row").alias("du"), F.col("c").alias("cu"))
    two = placed.select(F.col("gid").alias("v"), F.col("row").alias("dv"), F.col("c").alias("cv"))
    expanded = group_pairs.join(one, "u").join(two, "v").filter("cu <> cv and du <> dv").select(*_pairs(F.col("du"), F.col("dv")))
    rest = keep(spark, _promising(expanded.distinct().join(tried, ["u", "v"], "left_anti"), sketches), "rest")
    joined = _linked(spark, base, rest, links, members, repeated)[1] if rest.limit(1).count() else parts
    forget(spark, grouped, lists, pivots, tried, links, placed, rows, rest)

    # a component is named by its smallest identifier, and members stand for all rows with their set
    parts = members.select("row", "least", *_SET).join(joined.withColumnRenamed("vertex", "row"), "row", "left").withColumn("part", F.coalesce("component", "row"))
    names = parts.groupBy("part").agg(F.min("least").alias("component_id"))
    named = parts.join(names, "part").select(*_SET, "component_id")
    out = keys.select("doc", *_SET).join(named, _SET, "left")
    out = out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
    out = keep(spark, out, "classes")
    forget(spark, keys, members, joined)
    return out
