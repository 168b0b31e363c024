"""URL filters by a temporal list join.

A list is a table of dated entries (list_key, listed_at, action), where a key
is a host or a host and the first part of a path, and the action is "block" or
"allow" (an entry is taken back by the other action). Entries of a key become
validity intervals, each open until the key's next entry. A capture joins the
intervals of its own keys that hold its fetch time: its host, every parent
domain and its host with the first path part. The most specific active entry
decides.

The join is an equality join on the key with the interval as a further
condition; a hot host's captures are split by adaptive skew handling, and the
intervals of one key are as many as its entries.

Defined results: a null or unparsable url matches no entry and is allowed; a
null fetch time matches no entry; entries with a null key or date are ignored;
entries of one key at the same time are decided in favour of "block" and
repeated entries count once; repeated captures are judged row by row; empty
tables give empty results or matches; further columns of captures are kept,
except that one with the name of a result column gives way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.llm.text import packed

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)(/[^/?#]*)?"


def host(url):
    """Lower-case host of a url without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_extract(url, _URL, 1), r"^.*@|:[0-9]*$", "")), F.lit(""))


def keys(url):
    """Keys of a url, from the most specific to the least: host and path part, host, parent domains of two labels or more."""
    name, part = host(url), F.regexp_extract(url, _URL, 2)
    labels = F.split(name, r"\.")
    n = F.size(labels)
    # domains from the whole name down to two labels; a name of one label stands alone
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    with_path = F.when(F.length(part) > 1, F.array(F.concat(name, part))).otherwise(F.array().cast("array<string>"))
    return F.when(name.isNotNull(), F.concat(with_path, parents)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """list_key, action, valid_from, valid_to (exclusive, null while open) of dated entries."""
    clean = entries.filter(F.col("list_key").isNotNull() & F.col("listed_at").isNotNull())
    one = clean.groupBy("list_key", "listed_at").agg(F.max("action").alias("action"))  # "block" sorts after "allow"
    by_key = W.partitionBy("list_key").orderBy("listed_at")
    return one.select("list_key", "action", F.col("listed_at").alias("valid_from"), F.lead("listed_at").over(by_key).alias("valid_to"))


_RESULTS = ("verdict", "deciding_key", "n_active")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """`captures` with verdict ("block" or "allow"), deciding_key and n_active, the entries that hold at fetch time.

    Captures are judged by distinct (url, time) pairs, so that the join carries
    keys only and repeated captures do the work of one.
    """
    pair = captures.select(F.col(url_col).alias("url_"), F.col(time_col).alias("at_")).distinct()
    asked = pair.select("url_", "at_", F.posexplode(keys(F.col("url_"))).alias("rank_", "key_"))
    active = (
        (F.col("key_") == F.col("list_key"))
        & (F.col("at_") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("at_") < F.col("valid_to")))
    )
    found = (
        asked.join(intervals(entries), active)
        .groupBy("url_", "at_")
        .agg(F.min(F.struct("rank_", "key_", "action")).alias("first_"), F.count(F.lit(1)).alias("active_"))
    )
    rows = captures.select(packed(captures.drop(*_RESULTS)).alias("row_"), F.col(url_col).alias("u_"), F.col(time_col).alias("t_"))
    judged = rows.join(found, (F.col("u_") == F.col("url_")) & (F.col("t_") == F.col("at_")), "left")
    return judged.select(
        "row_.*",
        F.coalesce(F.col("first_.action"), F.lit("allow")).alias("verdict"),
        F.col("first_.key_").alias("deciding_key"),
        F.coalesce("active_", F.lit(0)).cast("long").alias("n_active"),
    )


def _number(text, first: int):
    """Eight hexadecimal digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), first, 8), 16, 10).cast("long")


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day; the tables hold none, so it is derived from the url."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (_number(F.coalesce("url", F.lit("")), 1) % 360).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_at"))


def derived_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and path parts that occur in `pages`.

    Of every five keys two are listed: blocked from a day on, and every other
    one of those taken back some weeks later.
    """
    found = pages.select(F.explode(keys(F.col("url"))).alias("list_key")).distinct()
    number = _number(F.col("list_key"), 1)
    begin = F.date_add(F.lit("2024-01-01").cast("date"), (_number(F.col("list_key"), 9) % 360).cast("int"))
    listed = found.filter(number % 5 < 2)
    blocks = listed.select("list_key", begin.alias("listed_at"), F.lit("block").alias("action"))
    back = listed.filter(number % 2 == 0).select("list_key", F.date_add(begin, 45).alias("listed_at"), F.lit("allow").alias("action"))
    return blocks.unionByName(back)


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + (('0x' || substr(md5(coalesce(url, '')), 1, 8))::BIGINT % 360)::INTEGER AS fetched_at,
    nullif(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)(/[^/?#]*)?', 1), '^.*@|:[0-9]*$', '', 'g')), '') AS h,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)(/[^/?#]*)?', 2) AS part
  FROM pages
), l AS (
  SELECT *, string_split(h, '.') AS labels FROM p WHERE h IS NOT NULL
), k AS (
  SELECT page_id, url, fetched_at, 0 AS rnk, h || part AS key FROM l WHERE length(part) > 1
  UNION ALL
  SELECT page_id, url, fetched_at, i AS rnk, array_to_string(labels[i:], '.') AS key
  FROM (SELECT *, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) AS i FROM l)
), listed AS (
  SELECT key, ('0x' || substr(md5(key), 1, 8))::BIGINT AS n,
    DATE '2024-01-01' + (('0x' || substr(md5(key), 9, 8))::BIGINT % 360)::INTEGER AS day
  FROM (SELECT DISTINCT key FROM k) WHERE ('0x' || substr(md5(key), 1, 8))::BIGINT % 5 < 2
), entries AS (
  SELECT key, 'block' AS action, day AS valid_from, CASE WHEN n % 2 = 0 THEN day + 45 END AS valid_to FROM listed
  UNION ALL
  SELECT key, 'allow', day + 45, NULL FROM listed WHERE n % 2 = 0
), hits AS (
  SELECT page_id, rnk, key, action FROM k JOIN entries USING (key)
  WHERE fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
), best AS (
  SELECT page_id, arg_min(action, rnk) AS action, arg_min(key, rnk) AS key, count(*)::BIGINT AS n FROM hits GROUP BY page_id
)
SELECT page_id, url, fetched_at, coalesce(action, 'allow') AS verdict, key AS deciding_key, coalesce(n, 0)::BIGINT AS n_active
FROM p LEFT JOIN best USING (page_id)
"""
