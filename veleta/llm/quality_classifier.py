"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence comes from a naive Bayes classifier over binned text
ratios. Sites add evidence of a second kind: labelled documents of a path
and of its host are counted, and the share of good documents of a path is
shrunk towards that of its host, and that of the host towards the share of all,
by Beta priors whose strength is estimated from the spread between sites. A
sparse site therefore says little. Document and site evidence are added on the
log-odds scale. The tables name no host and no path: `source` stands for the
host, `source` and `lang` together for the path.

The toxic label is judged beside it in the same way: sites by the same shrunken
shares, and words for the document's own evidence. Words that many toxic and few
other labelled documents hold are listed, the most frequent `TOXIC_WORDS` of
them; a document's distinct listed words add their log odds.

All counts are grouped aggregates over all labelled rows: class by feature bin,
class by word, class by host, class by path. Each is combined before its
shuffle. Bin counts and listed words are tables of fixed size and broadcast;
site posteriors are joined by key, with adaptive handling of hot sites. Labels
are broadcast to the texts up to `BROADCAST_LABELS` of them and joined by a
shuffle beyond. A document's own label never enters its own site evidence (it is
taken out again), so that scores of labelled documents mean the same as those
of others.

Defined results: null text counts as empty; a null host or path is a site of
its own; a document without labelled neighbours gets the prior of the level
above; without any labels every prior is one half; labels outside 0 and 1 are
ignored, several labels of a document count by the worse one; labels without a
column toxic leave every document to the prior; repeated rows are scored row by
row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.quality_rules import METRICS_SQL, metrics
from veleta.llm.shared import keep
from veleta.llm.text import let, words

#: Bins of a ratio in thousandths, by upper bounds; the last bin is open.
BINS = {
    "symbols": (1, 20, 50, 100, 300, 1000),
    "shouts": (1, 20, 100, 500),
    "stop_words": (20, 50, 100, 150, 200, 300, 400),
    "repeated": (50, 100, 200, 300, 500, 800, 950),
    "dup_lines": (50, 200, 400, 600, 800),
    "word_length": (3000, 4000, 4500, 5000, 5500, 6500, 8000),
}
#: Ratios of fewer words say nothing: such documents share one more bin of every ratio.
FEW_WORDS = 20
#: Pseudo-count of a bin.
SMOOTHING = 1.0
#: Bounds of a prior's strength, in documents.
STRENGTH = (1.0, 1000.0)
#: A listed word is in so many toxic documents, and in so many times the share of them that it is in of others.
TOXIC_LEAST = 5
TOXIC_RATIO = 8
#: At most so many words are listed, the ones in most toxic documents.
TOXIC_WORDS = 512
#: Up to so many labelled documents are broadcast to the texts.
BROADCAST_LABELS = 1 << 20


def _permille(num, den):
    return F.when(den > 0, (num * 1000) / den).otherwise(F.lit(0.0))


def _bin(value, bounds: tuple[int, ...]):
    out = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        out = F.when(value < bounds[i], i).otherwise(out)
    return out


def _bounded(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))


def _logit(x: Column) -> Column:
    return F.log(_bounded(x) / (1 - _bounded(x)))


def _sigmoid(x: Column) -> Column:
    return F.round(1 / (1 + F.exp(-x)), 6)


def clean_labels(labels: DataFrame) -> DataFrame:
    """doc_id, y (good), z (toxic); null where there is no such label."""
    toxic = F.col("toxic") if "toxic" in labels.columns else F.lit(None).cast("int")
    valid = lambda c: F.when(c.isin(0, 1), c.cast("int"))
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(valid(F.col("quality"))).alias("y"), F.max(valid(toxic)).alias("z"))


def distinct_words(text: Column) -> Column:
    """Distinct words in lower case, with the marks on them."""
    return F.array_distinct(words(F.lower(text)))


def toxic_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the listed words, and the log odds of each of them."""
    known = labels.filter("z is not null").select("doc_id", "z")
    few = known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    labelled = docs.select("doc_id", distinct_words(F.col("text")).alias("w")).join(F.broadcast(known) if few else known, "doc_id")
    total = labelled.agg(F.coalesce(F.sum("z"), F.lit(0)).cast("double").alias("all_toxic"), F.count(F.lit(1)).cast("double").alias("all_"))
    counts = labelled.select("z", F.explode("w").alias("word")).groupBy("word").agg(F.sum("z").cast("double").alias("t"), F.count(F.lit(1)).cast("double").alias("n"))
    others, all_others = F.col("n") - F.col("t"), F.col("all_") - F.col("all_toxic")
    listed = counts.filter(F.col("t") >= TOXIC_LEAST).join(F.broadcast(total))
    listed = listed.filter(F.col("t") * (all_others + 1) >= TOXIC_RATIO * (others + 1) * F.col("all_toxic"))
    odds = F.log(((F.col("t") + 1) / (F.col("all_toxic") + 2)) / ((others + 1) / (all_others + 2)))
    top = listed.orderBy(F.desc("t"), "word").limit(TOXIC_WORDS).select("word", odds.alias("odds"))
    return top.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "odds")))).alias("toxic"))


def binned(docs: DataFrame, toxic: DataFrame) -> DataFrame:
    """doc_id, host, path, one bin number for each ratio, and the evidence of the listed words."""
    rows = docs.select("doc_id", "text", F.col("source").alias("host"), F.struct("source", "lang").alias("path")).join(F.broadcast(toxic))
    q = metrics(rows, "text")
    n_words, lines = F.col("q_.w.n_words"), F.col("q_.l.n_lines")
    value = {
        "symbols": _permille(F.col("q_.n_symbols"), n_words),
        "shouts": _permille(F.col("q_.n_shouts"), n_words),
        "stop_words": _permille(F.col("q_.w.n_stop_words"), n_words),
        "repeated": _permille(F.col("q_.w.n_repeat_words"), n_words),
        "dup_lines": _permille(F.col("q_.l.n_dup_lines"), lines),
        "word_length": _permille(F.col("q_.w.word_chars"), n_words),
    }
    own = lambda n, v: F.when(n_words < FEW_WORDS, len(BINS[n]) + 1).otherwise(_bin(v, BINS[n]))

    def evidence(found: Column) -> Column:
        odds = F.transform(found, lambda w: F.element_at(F.col("toxic"), w))
        return F.struct(F.size(found).cast("long").alias("n"), F.aggregate(odds, F.lit(0.0), lambda acc, x: acc + x).alias("odds"))

    # the listed words that the text holds are looked up once; the words need not be distinct for that
    hits = let(F.array_sort(F.array_intersect(F.map_keys("toxic"), words(F.lower(F.col("text"))))), evidence)
    out = q.select("doc_id", "host", "path", *[own(n, v).alias(n) for n, v in value.items()], hits.alias("hits_"))
    return out.select("*", F.col("hits_.n").alias("n_toxic_words"), F.col("hits_.odds").alias("word_odds")).drop("hits_")


def bin_evidence(labelled: DataFrame) -> DataFrame:
    """One row: for each ratio an array with the log odds of each of its bins."""
    # one table of counts: (ratio, bin, class)
    ratio = F.explode(F.array(*[F.struct(F.lit(n).alias("ratio"), F.col(n).alias("bin")) for n in BINS]))
    counts = labelled.select("y", ratio.alias("r")).groupBy("r.ratio", "r.bin").agg(
        F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")
    )
    total = labelled.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("all_good"), F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).alias("all_bad"))
    columns = []
    for n, bounds in BINS.items():
        for i in range(len(bounds) + 2):
            at = (F.col("ratio") == n) & (F.col("bin") == i)
            columns += [
                F.coalesce(F.sum(F.when(at, F.col("good"))), F.lit(0)).alias(f"g_{n}_{i}"),
                F.coalesce(F.sum(F.when(at, F.col("bad"))), F.lit(0)).alias(f"b_{n}_{i}"),
            ]
    wide = counts.agg(*columns).join(F.broadcast(total))

    def odds(n: str, i: int, k: int):
        share = lambda side, all_: (F.col(f"{side}_{n}_{i}") + SMOOTHING) / (F.col(all_) + SMOOTHING * k)
        return F.log(share("g", "all_good") / share("b", "all_bad"))

    return wide.select(*[F.array(*[odds(n, i, len(b) + 2) for i in range(len(b) + 2)]).alias(f"odds_{n}") for n, b in BINS.items()])


def _strength(sites: DataFrame, name: str) -> DataFrame:
    """One row: the Beta strength by moments, from the spread of site shares (good, n) around `centre` beyond binomial noise."""
    n, p, centre = F.col("n"), F.col("good") / F.col("n"), F.col("centre")
    # expected squared deviation of a share: c (1 - c) (1 / n + rho) with rho = 1 / (strength + 1)
    excess = F.sum(n * F.pow(p - centre, 2)) - F.sum(centre * (1 - centre))
    scale = F.sum((n - 1) * centre * (1 - centre))
    rho = F.when(scale > 0, excess / scale)
    rho = F.greatest(F.least(F.coalesce(rho, F.lit(0.0)), F.lit(1.0)), F.lit(1e-6))
    return sites.filter("n > 0").agg(F.least(F.greatest(1 / rho - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1])).alias(name))


def sites(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labelled and positive documents by host and by path, and one row with the prior and both strengths; columns end in the label."""
    paths = rows.filter(F.col(label).isNotNull()).groupBy("host", "path").agg(F.sum(label).alias("good"), F.count(F.lit(1)).alias("n"))
    # counts of paths are summed again to hosts
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = hosts.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias(f"prior_{label}"))
    above = hosts.select(F.col("host").alias("host_"), (F.col("good") / F.col("n")).alias("centre"))
    one = total.join(F.broadcast(_strength(hosts.join(F.broadcast(total.withColumnRenamed(f"prior_{label}", "centre"))), f"host_strength_{label}")))
    one = one.join(F.broadcast(_strength(paths.join(above, F.col("host").eqNullSafe(F.col("host_"))), f"path_strength_{label}")))
    h = hosts.select(F.col("host").alias(f"host_{label}"), F.col("good").alias(f"hg_{label}"), F.col("n").alias(f"hn_{label}"))
    p = paths.select(F.col("path").alias(f"path_{label}"), F.col("good").alias(f"pg_{label}"), F.col("n").alias(f"pn_{label}"))
    return h, p, one


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_document, p_host, p_path, p_good, kept, and p_toxic, n_toxic_words, toxic."""
    # the ratios are worked out once; counts, site posteriors and scores read the small table of bins
    known = clean_labels(labels)
    rows = keep(docs.sparkSession, binned(docs, toxic_words(docs, known)).join(known, "doc_id", "left"), "bins")
    wide = rows.join(F.broadcast(bin_evidence(rows.filter("y is not null"))))
    for label in "yz":
        h, p, one = sites(rows, label)
        wide = wide.join(h, F.col("host").eqNullSafe(F.col(f"host_{label}")), "left").join(p, F.col("path").eqNullSafe(F.col(f"path_{label}")), "left").join(F.broadcast(one))
        # a document's own label is taken out
        own, times = F.coalesce(label, F.lit(0)), F.when(F.col(label).isNotNull(), 1).otherwise(0)
        host = (F.coalesce(f"hg_{label}", F.lit(0)) - own + F.col(f"host_strength_{label}") * F.col(f"prior_{label}")) / (F.coalesce(f"hn_{label}", F.lit(0)) - times + F.col(f"host_strength_{label}"))
        wide = wide.withColumn(f"p_host_{label}", host)
        path = (F.coalesce(f"pg_{label}", F.lit(0)) - own + F.col(f"path_strength_{label}") * F.col(f"p_host_{label}")) / (F.coalesce(f"pn_{label}", F.lit(0)) - times + F.col(f"path_strength_{label}"))
        wide = wide.withColumn(f"p_path_{label}", path)
    own_odds = sum((F.get(F.col(f"odds_{n}"), F.col(n)) for n in BINS), F.lit(0.0))
    out = wide.withColumn("own_odds", own_odds).select(
        "doc_id",
        _sigmoid(F.col("own_odds") + _logit(F.col("prior_y"))).alias("p_document"),
        F.round("p_host_y", 6).alias("p_host"),
        F.round("p_path_y", 6).alias("p_path"),
        _sigmoid(F.col("own_odds") + _logit(F.col("p_path_y"))).alias("p_good"),
        _sigmoid(F.col("word_odds") + _logit(F.col("p_path_z"))).alias("p_toxic"),
        "n_toxic_words",
    )
    return out.withColumns({"kept": F.col("p_good") >= 0.5, "toxic": (F.col("p_toxic") >= 0.5) & (F.col("n_toxic_words") > 0)})


def _oracle_sql() -> str:
    """The same by plain SQL, one table after the other."""
    ratios = {
        "symbols": ("n_symbols", "n_words"), "shouts": ("n_shouts", "n_words"), "stop_words": ("n_stop_words", "n_words"),
        "repeated": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "word_length": ("word_chars", "n_words"),
    }
    long = []
    for name, bounds in BINS.items():
        num, den = ratios[name]
        value = f"(CASE WHEN {den} > 0 THEN {num} * 1000 / {den}::DOUBLE ELSE 0 END)"
        bins = " ".join(f"WHEN {value} < {b} THEN {i}" for i, b in enumerate(bounds))
        long.append(f"SELECT doc_id, '{name}' AS ratio, {len(bounds) + 2} AS k, CASE WHEN n_words < {FEW_WORDS} THEN {len(bounds) + 1} {bins} ELSE {len(bounds)} END AS bin FROM m")
    rho = "greatest(least(coalesce(CASE WHEN sum((n - 1) * c * (1 - c)) > 0 THEN (sum(n * pow(g / n - c, 2)) - sum(c * (1 - c))) / sum((n - 1) * c * (1 - c)) END, 0), 1), 1e-6)"
    strength = f"least(greatest(1 / {rho} - 1, {STRENGTH[0]}), {STRENGTH[1]})::DOUBLE"
    part = """, path_{x} AS (SELECT source, lang, sum({x})::DOUBLE AS g, count(*)::DOUBLE AS n FROM r WHERE {x} IS NOT NULL GROUP BY 1, 2),
host_{x} AS (SELECT source, sum(g) AS g, sum(n) AS n FROM path_{x} GROUP BY 1),
prior_{x} AS (SELECT (coalesce(sum(g), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS prior FROM host_{x}),
hs_{x} AS (SELECT {strength} AS s FROM (SELECT g, n, (SELECT prior FROM prior_{x}) AS c FROM host_{x})),
ps_{x} AS (SELECT {strength} AS s FROM (SELECT p.g, p.n, h.g / h.n AS c FROM path_{x} p JOIN host_{x} h ON p.source IS NOT DISTINCT FROM h.source)),
seen_{x} AS (SELECT r.doc_id, (SELECT prior FROM prior_{x}) AS prior,
    (coalesce(h.g, 0) - coalesce({x}, 0) + (SELECT s FROM hs_{x}) * (SELECT prior FROM prior_{x})) / (coalesce(h.n, 0) - ({x} IS NOT NULL)::INTEGER + (SELECT s FROM hs_{x})) AS ph,
    (coalesce(p.g, 0) - coalesce({x}, 0)) AS pg, (coalesce(p.n, 0) - ({x} IS NOT NULL)::INTEGER) AS pn
  FROM r LEFT JOIN host_{x} h ON r.source IS NOT DISTINCT FROM h.source LEFT JOIN path_{x} p ON r.source IS NOT DISTINCT FROM p.source AND r.lang IS NOT DISTINCT FROM p.lang),
post_{x} AS (SELECT *, (pg + (SELECT s FROM ps_{x}) * ph) / (pn + (SELECT s FROM ps_{x})) AS pp FROM seen_{x})"""
    logit = lambda x: f"ln(least(greatest({x}, 1e-6), 1 - 1e-6) / (1 - least(greatest({x}, 1e-6), 1 - 1e-6)))"
    sigmoid = lambda x: f"round(1 / (1 + exp(-({x}))), 6)"
    return f"""
WITH {METRICS_SQL}, y AS (
  SELECT doc_id, min(CASE WHEN quality IN (0, 1) THEN quality END)::INTEGER AS y, max(CASE WHEN toxic IN (0, 1) THEN toxic END)::INTEGER AS z FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), r AS (
  SELECT doc_id, source, lang, y, z FROM documents LEFT JOIN y USING (doc_id)
), words AS (
  SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+')) AS word FROM documents)
), tw AS (
  SELECT word, sum(z)::DOUBLE AS t, count(*)::DOUBLE AS n, (SELECT sum(z) FROM r)::DOUBLE AS n_toxic, (SELECT count(z) FROM r)::DOUBLE AS n_all FROM words JOIN r USING (doc_id) WHERE z IS NOT NULL GROUP BY 1
), listed AS (
  SELECT word, ln(((t + 1) / (n_toxic + 2)) / ((n - t + 1) / (n_all - n_toxic + 2))) AS odds FROM tw
  WHERE t >= {TOXIC_LEAST} AND t * (n_all - n_toxic + 1) >= {TOXIC_RATIO} * (n - t + 1) * n_toxic ORDER BY t DESC, word LIMIT {TOXIC_WORDS}
), hits AS (
  SELECT doc_id, count(*)::BIGINT AS n, sum(odds) AS odds FROM words JOIN listed USING (word) GROUP BY 1
), bins AS (
  {" UNION ALL ".join(long)}
), counts AS (
  SELECT ratio, bin, sum(y)::DOUBLE AS g, sum(1 - y)::DOUBLE AS b FROM bins JOIN r USING (doc_id) WHERE y IS NOT NULL GROUP BY 1, 2
), own AS (
  SELECT doc_id, sum(ln(((coalesce(g, 0) + {SMOOTHING}::DOUBLE) / ((SELECT coalesce(sum(y), 0) FROM r) + {SMOOTHING}::DOUBLE * k)) / ((coalesce(b, 0) + {SMOOTHING}::DOUBLE) / ((SELECT coalesce(sum(1 - y), 0) FROM r) + {SMOOTHING}::DOUBLE * k)))) AS odds
  FROM bins LEFT JOIN counts USING (ratio, bin) GROUP BY 1
){part.format(x="y", strength=strength)}{part.format(x="z", strength=strength)}, out AS (
  SELECT doc_id, {sigmoid("own.odds + " + logit("post_y.prior"))} AS p_document, round(post_y.ph, 6) AS p_host, round(post_y.pp, 6) AS p_path, {sigmoid("own.odds + " + logit("post_y.pp"))} AS p_good,
    {sigmoid("coalesce(hits.odds, 0) + " + logit("post_z.pp"))} AS p_toxic, coalesce(hits.n, 0)::BIGINT AS n_toxic_words
  FROM own JOIN post_y USING (doc_id) JOIN post_z USING (doc_id) LEFT JOIN hits USING (doc_id)
)
SELECT *, p_good >= 0.5 AS kept, p_toxic >= 0.5 AND n_toxic_words > 0 AS toxic FROM out
"""


ORACLE_SQL = _oracle_sql()
