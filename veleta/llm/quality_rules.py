"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a ratio of two integer metrics with a lower and an upper bound in
thousandths, so that verdicts use whole numbers only. The projection holds
built-in functions alone: no user function, no shuffle, no second scan.

Defined results: null text counts as empty; an empty or blank text has no
words, fails the base rule and is not kept; repeated rows and tied identifiers
are judged row by row; an empty table gives an empty result; further columns
of the input pass through `filter_documents` and are ignored by `score`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.text import WORD, count_chars, let, packed, words

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up "
    "le la les de des du un une et en est que qui dans pour pas sur au aux avec par il elle ne se ce "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "el los las y por con para una su al lo como más pero sus del o"
).split()


@dataclass(frozen=True)
class Rule:
    """`low` <= 1000 * numerator / denominator <= `high`; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


RULES = (
    Rule("few_words", "n_words", "one", low=50_000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=500),
    Rule("word_length", "word_chars", "n_words", low=2_000, high=12_000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("shouting", "n_shouts", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=300),
)
#: The first two rules are the base rules of the contract.
BASE_RULES = ("few_words", "repeated_words")


def _covered(positions: Column) -> Column:
    """Size of the union of three-word windows that start at these sorted positions."""
    return F.aggregate(
        positions,
        F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def _repeated_by_text(w: Column) -> Column:
    """Repeated words by sorting the windows themselves; for rows whose hashes collide."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.cast("long").alias("p")),
    )

    def hits(s: Column) -> Column:
        found = F.filter(
            s,
            lambda x, k: ((k > 0) & (F.get(s, k - 1)["g"] == x["g"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["g"] == x["g"])),
        )
        return F.sort_array(F.transform(found, lambda x: x["p"]))

    return _covered(let(F.sort_array(windows), hits))


def _repeated(w: Column) -> Column:
    """Words that lie in a three-word window found at least twice.

    Each window becomes one long, the high bits of its hash before its
    position; after a sort, windows with an equal neighbour are the repeated
    ones. Those few are compared word for word, and a row in which two
    different windows share a hash is counted by the windows' own text.
    """
    n = F.size(w)
    #: Fixed value: positions take 24 bits, the hash 40.
    low = F.lit((1 << 24) - 1).cast("long")

    def same_hash(a: Column, b: Column) -> Column:
        return F.shiftright(a.bitwiseXOR(b), 24) == 0

    keys = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(-(1 << 24)).cast("long")).bitwiseOR(i.cast("long")),
    )

    def hits(s: Column) -> Column:
        last = F.size(s) - 1
        return F.filter(s, lambda x, k: ((k > 0) & same_hash(F.get(s, k - 1), x)) | ((k < last) & same_hash(F.get(s, k + 1), x)))

    def count(h: Column) -> Column:
        def words_at(x: Column) -> Column:
            return F.slice(w, x.bitwiseAND(low).cast("int") + 1, 3)

        checked = F.transform(h, lambda x, k: (k == 0) | ~same_hash(F.get(h, k - 1), x) | (words_at(F.get(h, k - 1)) == words_at(x)))
        return F.when(
            F.forall(checked, lambda ok: ok), _covered(F.sort_array(F.transform(h, lambda x: x.bitwiseAND(low))))
        ).otherwise(_repeated_by_text(w))

    return (
        F.when(n < 3, F.lit(0).cast("long"))
        .when(n >= (1 << 24), _repeated_by_text(w))
        .otherwise(let(let(F.sort_array(keys), hits), count))
    )


def _metrics(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def by_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    def by_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda y: y.rlike(r"^\s*[-*•]"))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter(x, lambda y: y.rlike(r"(\.\.\.|…)\s*$"))).cast("long").alias("n_ellipsis_lines"),
        )

    return F.struct(
        let(words(text), by_words).alias("w"),
        let(lines, by_lines).alias("l"),
        count_chars(text, "#*$%&|<>").alias("n_symbols"),
        count_chars(text, "!").alias("n_shouts"),
    )


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and, under the struct column `q_` (which a column of that name gives way to), its metrics."""
    return docs.withColumn("q_", _metrics(F.col(text_col)))


def _value(name: str) -> Column:
    if name == "one":
        return F.lit(1).cast("long")
    if name in ("n_symbols", "n_shouts"):
        return F.col(f"q_.{name}")
    part = "l" if name.endswith("_lines") else "w"
    return F.col(f"q_.{part}.{name}")


def passes(rule: Rule) -> Column:
    num, den = _value(rule.numerator) * 1000, _value(rule.denominator)
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (num >= den * rule.low)
    if rule.high is not None:
        ok = ok & (num <= den * rule.high)
    return ok


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: metrics, base verdict, verdict, and the rules that failed."""
    base = [passes(r) for r in rules if r.name in BASE_RULES]
    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))
    base_failed = F.lit(False)
    for ok in base:
        base_failed = base_failed | ~ok
    out = metrics(docs.select(F.col(id_col), F.col(text_col)), text_col)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_shouts")
    return out.select(
        F.col(id_col),
        *[_value(n).alias(n) for n in names],
        base_failed.alias("base_failed"),
        failed.alias("failed_rules_"),
    ).select("*", (F.size("failed_rules_") == 0).alias("kept")).select(
        id_col, *names, "base_failed", "kept", F.array_join("failed_rules_", ",").alias("failed_rules")
    )


def filter_documents(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass every rule, with their own columns only, whatever their names."""
    ok = F.lit(True)
    for r in rules:
        ok = ok & passes(r)
    return docs.select(packed(docs).alias("r"), _metrics(F.col(text_col)).alias("q_")).filter(ok).select("r.*")


_STOP_SQL = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

#: The metrics of every document, as the table m.
METRICS_SQL = r"""d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT doc_id, r, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), g AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM t
), dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS c FROM g) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY r
), m AS (
  SELECT doc_id,
    len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: lower(x) IN (STOP_WORDS)))::BIGINT AS n_stop_words,
    len(regexp_extract_all(text, '!'))::BIGINT AS n_shouts,
    len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]')))::BIGINT AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$')))::BIGINT AS n_ellipses
  FROM t LEFT JOIN rep USING (r)
)""".replace("STOP_WORDS", _STOP_SQL)

ORACLE_SQL = rf"""
WITH {METRICS_SQL}, v AS (
  SELECT *,
    n_words < 50 AS f1,
    n_repeat_words * 1000 > 500 * n_words AS f2,
    word_chars * 1000 < 2000 * n_words OR word_chars * 1000 > 12000 * n_words AS f3,
    n_symbols * 1000 > 100 * n_words AS f4,
    n_shouts * 1000 > 100 * n_words AS f5,
    n_stop_words * 1000 < 20 * n_words AS f6,
    n_dup_lines * 1000 > 500 * n_lines AS f7,
    n_bullets * 1000 > 900 * n_lines AS f8,
    n_ellipses * 1000 > 300 * n_lines AS f9
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_shouts,
  f1 OR f2 AS base_failed,
  NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8 OR f9) AS kept,
  concat_ws(',', CASE WHEN f1 THEN 'few_words' END, CASE WHEN f2 THEN 'repeated_words' END,
    CASE WHEN f3 THEN 'word_length' END, CASE WHEN f4 THEN 'symbols' END, CASE WHEN f5 THEN 'shouting' END,
    CASE WHEN f6 THEN 'stop_words' END, CASE WHEN f7 THEN 'duplicate_lines' END,
    CASE WHEN f8 THEN 'bullet_lines' END, CASE WHEN f9 THEN 'ellipsis_lines' END) AS failed_rules
FROM v
"""
