"""Pull-request catalog: one row for each agent and repository (and year), without fan-out.

Every side is reduced to one row for each join key before it is joined:
reviews to pull requests, tasks to the most certain one, repositories and
users to unique keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.operators.keys import latest_per_key


def repositories(repos: DataFrame) -> DataFrame:
    """One row for each identifier, the first by full name."""
    return latest_per_key(repos.filter("id is not null"), ["id"], [F.asc_nulls_last("full_name")])


def unique_urls(repos: DataFrame) -> DataFrame:
    """url -> id where one repository alone has the url."""
    return repos.filter("url is not null").groupBy("url").agg(F.min("id").alias("url_id"), F.count(F.lit(1)).alias("n_")).filter("n_ = 1").drop("n_")


def official_agent(column: Column, mapping: Mapping[str, str]) -> Column:
    return F.coalesce(*[F.when(column == k, F.lit(v)) for k, v in mapping.items()], column)


def pull_requests(
    prs: DataFrame, repos: DataFrame, mapping: Mapping[str, str], agents: Sequence[str] | None, start: str, end: str, most: int | None = None, annual: bool = False
) -> DataFrame:
    """Unique pull requests in the window, with their repository recovered by url and their business key.

    `most` caps the input by identifier, before anything else, where a caller asks for it.
    """
    if most is not None:
        if isinstance(most, bool) or not isinstance(most, int) or most < 0:
            raise ValueError("the cap must be a whole number of at least 0")
        prs = prs.orderBy("id").limit(most)
    rows = prs.withColumn("created_at", F.col("created_at").cast("string").try_cast("timestamp")).withColumn(
        "merged_at", F.col("merged_at").cast("string").try_cast("timestamp")
    )
    rows = latest_per_key(rows.filter("id is not null"), ["id"], [F.desc_nulls_last("created_at"), F.asc("html_url"), F.asc("agent")])
    rows = rows.withColumn("agent", official_agent(F.col("agent"), mapping))
    rows = rows.filter((F.col("created_at") >= F.lit(start).cast("timestamp")) & (F.col("created_at") < F.lit(end).cast("timestamp") + F.expr("interval 1 day")))
    if agents is not None:
        rows = rows.filter(F.col("agent").isin(*agents))
    rows = rows.join(unique_urls(repos), F.col("repo_url") == F.col("url"), "left").withColumn("repo_id", F.coalesce("repo_id", "url_id")).drop("url", "url_id")
    key = F.coalesce(
        F.concat(F.lit("id:"), F.col("repo_id").cast("string")),
        F.concat(F.lit("url:"), F.nullif("repo_url", F.lit(""))),
        F.concat(F.lit("pr:"), F.col("id").cast("string")),
    )
    return rows.withColumn("repo_key", F.concat(key, F.lit(":year:"), F.year("created_at")) if annual else key)


def reviews_by_pr(reviews: DataFrame) -> DataFrame:
    one = latest_per_key(reviews.filter("id is not null"), ["id"], [F.asc("pr_id"), F.asc("state"), F.asc("user_type")])
    return one.groupBy("pr_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(F.col("user_type") == "User").alias("human_review_count"),
        F.count_if(F.col("user_type") == "Bot").alias("bot_review_count"),
        F.count_if(F.col("state") == "APPROVED").alias("approved_review_count"),
        F.count_if(F.col("state") == "CHANGES_REQUESTED").alias("changes_requested_review_count"),
    )


def tasks_by_pr(tasks: DataFrame) -> DataFrame:
    return latest_per_key(tasks.filter("id is not null"), ["id"], [F.desc_nulls_last("confidence"), F.asc("type")])


_REVIEWS = ("review_count", "human_review_count", "bot_review_count", "approved_review_count", "changes_requested_review_count")


def _cells(prs: DataFrame, reviews: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """Roll-ups for each agent, repository key, user and task type: the one wide join, combined before its shuffle."""
    people = users.filter("id is not null").select(F.col("id").cast("long").alias("known_id")).distinct()
    needed = prs.select("id", "agent", "repo_key", "repo_id", "repo_url", "user_id", "title", "html_url", "created_at", "merged_at")
    joined = (
        needed.join(reviews_by_pr(reviews), needed["id"] == F.col("pr_id"), "left")
        .join(tasks_by_pr(tasks).select(F.col("id").alias("task_id"), "type", "confidence"), needed["id"] == F.col("task_id"), "left")
        .join(people, needed["user_id"] == F.col("known_id"), "left")
    )
    return joined.groupBy("agent", "repo_key", "user_id", "type").agg(
        F.min("repo_id").alias("repo_id"),
        F.min("repo_url").alias("repo_url"),
        F.count(F.lit(1)).alias("prs"),
        F.count("merged_at").alias("merged"),
        F.max("known_id").alias("known_id"),
        F.min("created_at").alias("first"),
        F.max("created_at").alias("last"),
        F.min(F.struct(needed["id"].alias("id"), "title", "html_url")).alias("sample"),
        F.count("pr_id").alias("reviewed"),
        *[F.sum(c).alias(c) for c in _REVIEWS],
        F.sum("confidence").alias("confidence"),
        F.count("confidence").alias("confidences"),
    )


def _groups(cells: DataFrame) -> DataFrame:
    by_user = cells.groupBy("agent", "repo_key", "user_id").agg(
        F.min("repo_id").alias("repo_id"),
        F.min("repo_url").alias("repo_url"),
        F.max("known_id").alias("known_id"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("sample").alias("sample"),
        F.sum(F.when(F.col("type").isNotNull(), F.col("prs")).otherwise(0)).alias("typed"),
        *[F.sum(c).alias(c) for c in ("prs", "merged", "reviewed", *_REVIEWS, "confidence", "confidences")],
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return by_user.groupBy("agent", "repo_key").agg(
        F.min("repo_id").alias("repo_id"),
        F.min("repo_url").alias("repo_url"),
        F.sum("prs").alias("pull_requests_count"),
        F.sum("merged").alias("merged_pull_requests"),
        F.count("user_id").alias("unique_contributors"),
        F.count("known_id").alias("known_contributors"),
        F.date_format(F.min("first"), iso).alias("first_activity"),
        F.date_format(F.max("last"), iso).alias("last_activity"),
        F.min("sample")["title"].alias("sample_pr_title"),
        F.min("sample")["html_url"].alias("sample_pr_url"),
        F.sum("reviewed").alias("reviewed_pull_requests"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _REVIEWS],
        F.sum("typed").alias("task_classified_pull_requests"),
        (F.sum("confidence") / F.nullif(F.sum("confidences"), F.lit(0))).alias("task_confidence_mean"),
    )


def _type_maps(cells: DataFrame) -> DataFrame:
    counts = cells.filter("type is not null").groupBy("agent", "repo_key", "type").agg(F.sum("prs").alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct("type", "n")))  # as many as there are types
    return counts.groupBy("agent", "repo_key").agg(F.map_from_entries(pairs).alias("task_type_counts"))


def grouped(prs: DataFrame, reviews: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """18 roll-ups for each agent and repository key."""
    return _groups(_cells(prs, reviews, tasks, users))


def task_counts(prs: DataFrame, reviews: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """Map of task type to pull requests, sorted by type, for each agent and repository key."""
    return _type_maps(_cells(prs, reviews, tasks, users))


#: Start of a repository address that is not part of its name.
ADDRESS = r"^https?://(api\.)?github\.com/(repos/)?"


def catalog(prs: DataFrame, repos: DataFrame, reviews: DataFrame, tasks: DataFrame, users: DataFrame) -> DataFrame:
    """The groups with names, languages, stars and task maps."""
    r = repos.select(
        F.col("id").alias("r_id"), F.col("url").alias("repo_api_url"), F.col("full_name").alias("r_name"), "language", "license", F.col("stars").alias("r_stars"), F.col("forks").alias("r_forks")
    )
    cells = _cells(prs, reviews, tasks, users)  # both roll-ups read one shuffle of them
    g = _groups(cells)
    name = F.coalesce(F.nullif("r_name", F.lit("")), F.nullif(F.regexp_replace("repo_url", ADDRESS, ""), F.lit("")), F.col("repo_key"))
    out = g.join(r, F.col("repo_id") == F.col("r_id"), "left").join(_type_maps(cells), ["agent", "repo_key"], "left")
    return out.withColumns({"full_name": name, "stars": F.coalesce("r_stars", F.lit(0)).cast("long"), "forks": F.coalesce("r_forks", F.lit(0)).cast("long")}).drop(
        "r_id", "r_name", "r_stars", "r_forks"
    )


_TEXTS = ("repo_url", "repo_api_url", "full_name", "language", "license", "sample_pr_title", "sample_pr_url")


def records(rows: DataFrame, total_users: int, dataset: str) -> DataFrame:
    """Finished records: identifier, activity year, merge rate, empty texts for nulls."""
    key = F.concat_ws(":", "agent", "repo_key")
    year = F.when(F.col("repo_key").contains(":year:"), F.element_at(F.split("repo_key", ":year:"), -1).cast("int"))
    out = rows.withColumns(
        {
            "id": key,
            "activity_year": year,
            "merge_rate": F.bround(F.col("merged_pull_requests") / F.col("pull_requests_count"), 4),
            "dataset": F.lit(dataset),
            "total_users_dataset": F.lit(total_users).cast("long"),
            "task_type_counts": F.coalesce("task_type_counts", F.create_map().cast("map<string,bigint>")),
            **{c: F.coalesce(F.col(c), F.lit("")) for c in _TEXTS},
        }
    )
    return out.drop("repo_key")


def in_order(rows: DataFrame) -> DataFrame:
    """Catalog records as they are written: most pull requests first."""
    return rows.orderBy(F.desc("pull_requests_count"), "agent", "repo_key")


def input_counts(**tables: DataFrame) -> DataFrame:
    """One row: rows of each input table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias(f"{name}_rows_input"))
        out = one if out is None else out.join(one)
    return out


def agent_counts(prs: DataFrame) -> DataFrame:
    """Pull requests of each agent."""
    return prs.groupBy("agent").agg(F.count(F.lit(1)).alias("pull_requests"))


def statistics(prs: DataFrame, rows: DataFrame, repos: DataFrame | None = None, users: DataFrame | None = None) -> DataFrame:
    """One row: pull requests, unresolved ones, groups, linked reviews and tasks; repositories and users where they are given."""
    read = prs.agg(F.count(F.lit(1)).alias("pull_request_rows_read"), F.count_if(F.col("repo_id").isNull()).alias("unresolved_repository_prs"))
    made = rows.agg(
        F.count(F.lit(1)).alias("records_generated"),
        F.coalesce(F.sum("review_count"), F.lit(0)).alias("review_rows_linked"),
        F.coalesce(F.sum("task_classified_pull_requests"), F.lit(0)).alias("task_rows_linked"),
    )
    out = read.join(made)
    if repos is not None:
        out = out.join(repos.agg(F.count(F.lit(1)).alias("repository_rows_read")))
    if users is not None:
        out = out.join(users.agg(F.count(F.lit(1)).alias("user_rows_read"), F.count_distinct("id").alias("unique_users")))
    return out
