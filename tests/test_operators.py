"""Operators on hand-made rows."""

import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta import contracts
from veleta.functions import cleaning
from veleta.operators import keys, measures, rules, staging
from veleta.plans import catalog, derived, gold, quality
from veleta.sources import mappers, raw, sinks
from veleta.streaming import incremental


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# de-duplication and upserts

SNAPSHOT = "fuente string, plataforma string, id_origen_registro string, nombre_agente string, fecha_evento string, raw_file_id long, raw_record_id long, cantidad_menciones long"


def snapshots(spark, *rows):
    return spark.createDataFrame([("github", None, *r[:1], "Cursor", *r[1:]) for r in rows], SNAPSHOT)


def test_newest_snapshot_wins(spark):
    out = keys.snapshot_dedup(snapshots(spark, ("1", "2025-01-01", 10, 1, 4), ("1", "2025-03-01", 12, 2, 7)))
    assert [(r.fecha_evento, r.cantidad_menciones) for r in out.collect()] == [("2025-03-01", 7)]
    assert keys.snapshot_dedup(snapshots(spark, ("101", "2025-01-01", 1, 1, 1), ("102", "2025-01-01", 1, 2, 1))).count() == 2
    for order in ((0, 1), (1, 0)):
        both = [("1", "2025-01-01", 10, 41, 3), ("1", "2025-01-01", 10, 42, 9)]
        assert keys.snapshot_dedup(snapshots(spark, *(both[i] for i in order))).first().raw_record_id == 42


def test_upsert_never_goes_back(spark):
    old = spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], "k string, v long, t string")
    new = spark.createDataFrame([("a", 4, "late"), ("b", 2, "new"), ("c", 1, "new")], "k string, v long, t string")
    once = keys.upsert_newest(old, new, ["k"], ["v"])
    assert rows_of(once) == [("a", 5, "old"), ("b", 2, "new"), ("c", 1, "new")]
    assert rows_of(keys.upsert_newest(once, new, ["k"], ["v"])) == rows_of(once)


def test_pending_files(spark):
    files = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    done = spark.createDataFrame([(1, "v1"), (2, "v1")], "id long, version string")
    assert rows_of(keys.pending(files, done, "id", "version", "v1")) == [(3,)]
    with pytest.raises(ValueError):
        keys.pending(files, done, "id", "version", "v2")
    assert keys.pending(files, done, "id", "version", "v2", rebuild=True).count() == 3


def test_surrogate_keys_are_stable(spark):
    new = spark.createDataFrame([(f"n{i:03d}", "x") for i in range(50)], "name string, kind string")
    first = keys.with_surrogate_keys(new, spark.createDataFrame([], "name string, kind string, id long"), ["name"], "id")
    ids = {r.name: r.id for r in first.collect()}
    assert sorted(ids.values()) == list(range(1, 51)) and ids["n000"] == 1
    later = spark.createDataFrame([("a", "y"), ("n010", "z")], "name string, kind string")
    second = {r.name: (r.id, r.kind) for r in keys.with_surrogate_keys(later, first, ["name"], "id").collect()}
    assert second["a"] == (51, "y") and second["n010"] == (ids["n010"], "z") and second["n049"] == (ids["n049"], "x")


def test_numbering_loses_nothing_and_repeats_nothing(spark):
    """A million wide rows over 200 shuffle partitions, most of their ranges uneven."""
    rows, partitions = 1_000_000, spark.conf.get("spark.sql.shuffle.partitions")
    wide = spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), *[F.xxhash64("id", F.lit(k)).alias(f"c{k}") for k in range(8)], F.repeat(F.lit("x"), 60).alias("text"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        out = keys.numbered_by(wide, ["key"], "number")
        r = out.agg(F.count("*").alias("n"), F.min("number").alias("a"), F.max("number").alias("b"), F.count_distinct("number").alias("d"), F.count_distinct("key").alias("k")).first()
        assert (r.n, r.a, r.b, r.d, r.k) == (rows, 1, rows, rows, rows)
        later = out.select("number", F.lead("key").over(W.partitionBy(F.floor(F.col("number") / 5000)).orderBy("number")).alias("next"), "key")
        assert later.filter("next < key").count() == 0  # in the order of the key
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_fact_keeps_key_and_first_lineage(spark):
    old = spark.createDataFrame([(7, "g1", "raw:1", 2)], "id long, grain string, lineage string, n long")
    new = spark.createDataFrame([("g1", "raw:9", 9), ("g2", "raw:10", 1)], "grain string, lineage string, n long")
    out = {r.grain: (r.id, r.lineage, r.n) for r in keys.upsert_fact(new, old, ["grain"], "id", "lineage").collect()}
    assert out == {"g1": (7, "raw:1", 9), "g2": (8, "raw:10", 1)}


def test_consolidation(spark):
    new = spark.createDataFrame([(1, "new"), (2, "b"), (3, "c")], "id long, title string")
    old = spark.createDataFrame([(1, "old"), (99, "z"), (None, "n")], "id long, title string")
    assert sorted(str(tuple(r)) for r in keys.consolidate(new, old, "id").collect()) == ["(1, 'new')", "(2, 'b')", "(3, 'c')", "(99, 'z')", "(None, 'n')"]


def test_identity_folds_missing_parts(spark):
    df = spark.createDataFrame([(None, "a", 1, "x"), (None, "a", 3, "y"), ("N/A", "a", 2, "z"), ("b", None, 1, "w")], "p string, q string, v long, t string")
    assert sorted(map(str, keys.snapshot_dedup(df, ["p", "q"], ["v"]).collect())) == sorted(map(str, df.filter("t in ('y', 'w')").collect()))
    assert keys.snapshot_removed(df, ["p", "q"]).first().eliminados == 2
    up = keys.upsert_newest(df.filter("v = 3"), df.filter("v < 3"), ["p", "q"], ["v"])
    assert sorted(r.t for r in up.collect()) == ["w", "y"]


def test_ledger(spark):
    files = spark.createDataFrame([(1, "github"), (2, "github"), (3, "reddit")], "id long, fuente string")
    rows = spark.createDataFrame([(1,), (1,), (3,)], "raw_file_id long")
    new = keys.processed_counts(files.filter("id < 3"), rows, "v2", "r")
    old = spark.createDataFrame([(1, "v1", "q", 9), (3, "v1", "q", 1)], new.schema)
    out = {r.file_id: (r.transformation_version, r.records_processed) for r in keys.ledger_upsert(old, new).collect()}
    assert out == {1: ("v2", 2), 2: ("v2", 0), 3: ("v1", 1)}
    assert [r.file_id for r in keys.processed_of(keys.ledger_upsert(old, new), files, ["reddit"]).collect()] == [3]


def test_star_schema_is_loaded_twice(spark):
    """The same entity again: fact id, first lineage and dimension keys stay, the rest is refreshed; empty staging deletes nothing."""
    kinds = contracts.STAGING
    base = {"id_origen_registro": "repo-1", "fuente": "github", "tipo_fuente": "api", "plataforma": "VS Code", "categoria": "comunidad", "nombre_agente": "Codex", "fecha_evento": datetime.date(2026, 1, 1), "dim_nombre_plataforma": "VS Code", "dim_tipo_plataforma": "IDE", "dim_ecosistema": "a", "dim_nombre_tecnologia": "Python", "dim_categoria_tecnologia": "x", "dim_nombre_comunidad": " ", "cantidad_menciones": 1, "cantidad_interacciones": 2, "raw_file_id": 1, "raw_record_id": 10, "titulo": "old"}
    schema = ", ".join(f"{c} {t}" for c, t in kinds.items())
    staged = lambda *rows: spark.createDataFrame([tuple((base | r).get(c) for c in kinds) for r in rows], schema)
    dims, facts = gold.load(staged({}, {"id_origen_registro": "repo-2", "nombre_agente": "Cline", "raw_record_id": 11}))
    first = {r.id_origen_registro: r for r in facts.collect()}
    assert sorted(r.id_hecho for r in first.values()) == [1, 2] and first["repo-1"].fact_lineage_key == "raw:10" and first["repo-1"].score_comunidad == 3
    assert [r.nombre_comunidad for r in dims["comunidad"].collect()] == ["Comunidad no determinada"]
    again = {"cantidad_interacciones": 9, "raw_record_id": 12, "titulo": "new", "dim_ecosistema": "b", "fecha_evento": datetime.date(2026, 2, 1), "raw_file_id": 2}
    dims2, facts2 = gold.load(staged(again), dims, facts)
    second = {r.id_origen_registro: r for r in facts2.collect()}
    r, old = second["repo-1"], first["repo-1"]
    assert len(second) == 2 and (r.id_hecho, r.fact_lineage_key, r.id_agente, r.id_plataforma, r.id_comunidad) == (old.id_hecho, "raw:10", old.id_agente, old.id_plataforma, old.id_comunidad)
    assert (r.raw_record_id, r.titulo, r.cantidad_interacciones) == (12, "new", 9) and dims2["plataforma"].first().ecosistema == "b" and r.id_tiempo == 2
    assert gold.load(staged({}).limit(0), dims2, facts2)[1].count() == 2


def test_repeated_grains_load_alike_any_number_of_times(spark):
    """Several new rows of one grain or member in one load: the newest counts; further loads of the same rows change no count and no key."""
    schema = "grain string, part int, lineage string, version int, n int"
    rows = spark.createDataFrame([("b", 1, "l1", 1, 10), ("b", 1, "l2", 3, 30), ("b", 1, "l3", 2, 20), ("a", 1, "l4", 1, 1), ("a", 1, "l4", 1, 1), (None, 1, "l5", 1, 5), (None, 1, "l6", 2, 6)], schema)
    upsert = lambda new, old: keys.unique(keys.upsert_fact(new, old, ["grain", "part"], "id", "lineage", ["version"]), ["grain", "part"])
    seen, old = [], None
    for _ in range(3):
        old = upsert(rows, old)
        seen.append(sorted((str(r.grain), r.id, r.lineage, r.n) for r in old.collect()))
    assert seen[0] == seen[1] == seen[2] == [("None", 1, "l6", 6), ("a", 2, "l4", 1), ("b", 3, "l2", 30)]
    later = upsert(spark.createDataFrame([("b", 1, "l9", 1, 99), ("c", 1, "m1", 1, 1), ("c", 1, "m2", 2, 2)], schema), old)
    assert sorted((str(r.grain), r.id, r.lineage, r.n) for r in later.collect()) == [("None", 1, "l6", 6), ("a", 2, "l4", 1), ("b", 3, "l2", 99), ("c", 4, "m2", 2)]
    with pytest.raises(keys.RepeatedKey):
        keys.unique(later.union(later), ["grain"])
    members = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new"), ("w", 1, "w"), ("w", 1, "w")], "name string, v int, kind string")
    known = None
    for _ in range(3):
        known = keys.with_surrogate_keys(members, known, ["name"], "id", ["v"])
        assert sorted((r.name, r.id, r.kind) for r in known.collect()) == [("w", 1, "w"), ("x", 2, "new")]


def shared_tables(spark, after=frozenset()):
    """Tables in the shared folder that were not there before."""
    return {t for t in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("*-*") if t not in after}


def test_slices_number_as_one_does_and_leave_nothing(spark, monkeypatch):
    """Rows of a large table are shuffled slice by slice: the same rows win, the same numbers follow, also where most rows share the first key or a grain."""
    schema = "part int, grain string, lineage string, version int, n int"
    rows = spark.createDataFrame([(None if i % 50 == 0 else 1 + i % 17 // 16, None if i % 40 == 0 else f"g{i % 1500:04d}" if i % 3 else "hot", f"l{i}", i % 7, i) for i in range(4000)], schema)
    upsert = lambda **k: sorted((r.id, str(r.part), str(r.grain), r.lineage, r.n) for r in keys.upsert_fact(rows, None, ["part", "grain"], "id", "lineage", ["version"], **k).collect())
    want, before = upsert(), shared_tables(spark)
    assert [r[0] for r in want] == list(range(1, len(want) + 1)) and len({r[1:3] for r in want}) == len(want)
    monkeypatch.setattr(keys, "SLICE_ROWS", 500)
    for few in (keys.FEW_ROWS, 10):
        monkeypatch.setattr(keys, "FEW_ROWS", few)
        assert upsert(rows=4000) == want
    made = sorted(shared_tables(spark, before))
    assert [t.name.split("-")[0] for t in made] == ["numbered", "numbered", "ranges", "slices", "slices"] and not any(list(t.rglob("*.parquet")) for t in made[3:])
    assert all(spark.read.parquet(str(t)).select("slice_").distinct().count() > 4 for t in made[:2])


def test_keys_of_one_digest_are_compared_themselves(spark):
    alike = spark.createDataFrame([(None, "a"), ("a", None), ("b", "b")], "p string, q string")
    assert alike.select(F.xxhash64("p", "q")).distinct().count() == 2 and keys.unique(alike, ["p", "q"]) is alike
    with pytest.raises(keys.RepeatedKey, match="2 rows of p=None, q=a"):
        keys.unique(alike.union(alike.filter("q = 'a'")), ["p", "q"])


def test_a_load_keeps_its_facts_once(spark, sf_dir, monkeypatch):
    """Staging rows and copies of the facts on the way are gone when a load ends, in parts or at once; parts hold every row."""
    from veleta.registry import gold as queries

    loaded = []
    for rows in (keys.SLICE_ROWS, 1000):
        monkeypatch.setattr(keys, "SLICE_ROWS", rows)
        parts, before = queries._staging_parts(spark, sf_dir), shared_tables(spark)
        loaded.append(rows_of(gold.load(parts)[1].select("id_hecho", "id_agente", "id_origen_registro", "fact_lineage_key")))
        files = {t.name: list(map(str, t.rglob("*.parquet"))) for t in shared_tables(spark, before)}
        large = [t.split("-")[0] for t, at in files.items() if at and spark.read.parquet(*at).count() > 3000]
        assert large == ["numbered"]
    assert len(parts) > 3 and loaded[0] == loaded[1] and len(loaded[0]) > 5000


def test_a_stored_star_schema_is_the_only_copy(spark, sf_dir):
    """Reports read the snapshot; the tables that it was loaded from are gone when it is published."""
    from veleta.registry import runs

    before = shared_tables(spark)
    trend = runs.QUERIES["star_monthly_trend"](spark, sf_dir)
    files = {t.name: list(map(str, t.rglob("*.parquet"))) for t in shared_tables(spark, before)}
    stored = [f for at in files.values() for f in at if "/fact/" in f]
    assert trend.agg(F.sum("total_observaciones")).first()[0] == spark.read.parquet(*stored).count() > 5000
    assert [t.split("-")[0] for t, at in files.items() if at and spark.read.parquet(*at).count() > 3000] == ["star"]


def test_star_schema_keeps_grains_unique(spark):
    kinds = contracts.STAGING
    base = {"id_origen_registro": "repo-1", "fuente": "github", "tipo_fuente": "api", "plataforma": "VS Code", "categoria": "c", "nombre_agente": "Codex", "fecha_evento": datetime.date(2026, 1, 1), "dim_nombre_plataforma": "VS Code", "dim_nombre_tecnologia": "Python", "dim_nombre_comunidad": "c", "raw_file_id": 1, "raw_record_id": 10}
    schema = ", ".join(f"{c} {t}" for c, t in kinds.items())
    rows = [base | r for r in ({}, {"raw_record_id": 12, "cantidad_interacciones": 7}, {"fecha_evento": datetime.date(2025, 1, 1), "raw_record_id": 99}, {"id_origen_registro": "repo-0", "raw_record_id": 1})]
    staged = spark.createDataFrame([tuple(r.get(c) for c in kinds) for r in rows], schema)
    dims, facts, seen = None, None, []
    for _ in range(3):
        dims, facts = gold.load(staged, dims, facts)
        seen.append(sorted((r.id_hecho, r.id_origen_registro, r.fact_lineage_key, r.cantidad_interacciones) for r in facts.collect()))
    assert seen[0] == seen[1] == seen[2] == [(1, "repo-0", "raw:1", 0), (2, "repo-1", "raw:12", 7)]


def test_profiles():
    with pytest.raises(ValueError, match="profile"):
        gold.in_profile(F.lit("x"), ("github",), "nothing")


# dates and values


def test_dates(spark):
    values = [("2025-08-19T23:30:00Z", None), (None, "2026-07-14T01:00:00Z"), ("2024-02-03T12:30:00+00:00", None), ("2023-01-22T00:00:00", None), ("junk", None), ("2021-07-12", None)]
    out = cleaning.dated(spark.createDataFrame(values, "fecha_evento_raw string, fecha_carga_raw string"))
    assert rows_of(out.select(F.col("fecha_evento").cast("string"), "is_imputed_date")) == [
        ("2021-07-12", False), ("2023-01-22", False), ("2024-02-03", False), ("2025-08-19", False), ("2026-07-14", True)
    ]


def test_title_case(spark):
    got = spark.createDataFrame([("o'NEIL jean-luc 3d élan",)], "s string").select(cleaning.title_case(F.col("s"))).first()[0]
    assert got == "o'NEIL jean-luc 3d élan".title()


def test_rules_know_accented_capitals(spark):
    df = spark.createDataFrame([("REVISIÓN DE CÓDIGO",), ("DEPURACIÓN lenta",), ("ótesting",)], "s string")
    found = rules.first_match(F.col("s"), rules.TECHNOLOGY_RULES, ("name", "category", "domain"))
    assert [r[0] for r in df.select(found["name"]).collect()] == ["Revisión de código", "Depuración", None]


def test_written_numbers_and_names(spark):
    df = spark.createDataFrame([("3k",), ("1,200",), ("1.5k",), ("none",), ("",), (None,), ("abc",)], "v string")
    assert [r[0] for r in df.select(cleaning.dirty_number(F.col("v"))).collect()] == [3000, 1200, 15000, 0, 0, 0, 0]
    names = spark.createDataFrame([("my copilot",), (" GPT-4 ",), ("aider tool",), (None,)], "v string")
    assert [r[0] for r in names.select(cleaning.standard_name(F.col("v"))).collect()] == ["GitHub Copilot", "ChatGPT", "Aider Tool", "Desconocido"]


def test_year_slices(spark):
    one = spark.sql("select date'2020-02-29' a, date'2021-01-01' b")
    out = [(str(r.slice_start), str(r.slice_end)) for r in cleaning.year_slices(one, "a", "b").collect()]
    assert out == [("2020-02-29", "2020-12-31"), ("2021-01-01", "2021-01-01")]


# rules


def test_agent_aliases(spark):
    df = spark.createDataFrame([("Google_Jules", ""), ("", "GOOGLE JULES"), ("", "Jules Verne"), ("", "Google Julesville"), (None, "use cursor_ai today")], "d string, t string")
    got = [r[0] for r in df.select(rules.detect_agent(F.col("d"), F.col("t"), F.lit(None).cast("string"))).collect()]
    assert got == ["Google Jules", "Google Jules", rules.OTHER_AGENT, rules.OTHER_AGENT, "Cursor Agent"]


def test_semantic_dimensions(spark):
    rows = [
        ("github", "Cline", "repo", "", "Python", "acme-ai", "Organization", None),
        ("catalogo", "Claude Code", "x", "", "TypeScript", "owner", None, None),
        ("stackoverflow", None, "Usar React con VS Code", "", "", None, None, None),
        ("gnews", None, "News", "", None, "Reuters", None, None),
        ("arxiv", None, "Paper", "", None, "Universidad de Guayaquil", None, "Ecuador"),
    ]
    df = spark.createDataFrame(rows, "fuente string, nombre_agente string, titulo string, texto string, tecnologia_raw string, comunidad_raw string, tipo_comunidad_raw string, region_comunidad_raw string")
    got = {r.fuente: r for r in rules.enrich(df).collect()}
    assert [got[s].dim_nombre_plataforma for s in ("github", "catalogo", "stackoverflow", "gnews")] == ["VS Code", "Terminal / CLI", "VS Code", "No determinada"]
    assert [got[s].dim_plataforma_metodo for s in ("github", "stackoverflow", "arxiv")] == ["regla_agente", "regla_contextual", "sin_evidencia"]
    assert (got["github"].dim_nombre_tecnologia, got["github"].dim_tecnologia_metodo) == ("Python", "metadata_estructurada")
    assert (got["stackoverflow"].dim_nombre_tecnologia, got["stackoverflow"].dim_tecnologia_metodo) == ("React", "regla_contextual")
    assert [got[s].dim_nombre_comunidad for s in ("github", "stackoverflow", "gnews")] == ["acme-ai", "Stack Overflow", "Reuters"]
    assert got["arxiv"].dim_region_comunidad == "Ecuador" and got["github"].dim_region_comunidad == "Global"


# mappers


def observe(spark, source, schema, *rows):
    return mappers.normalize(spark.createDataFrame(list(rows), schema), source)


def test_mappers(spark):
    repo = observe(spark, "github", "id long, name string, stargazers_count long, open_issues_count long, language string, owner struct<login:string,type:string>", (5, "r", 7, 3, "Python", ("lab", "Organization"))).first()
    assert (repo.id_origen_registro, repo.stars_github, repo.cantidad_menciones, repo.cantidad_interacciones, repo.comunidad_raw, repo.score_popularidad) == ("5", 7, 1, 3, "lab", None)
    q = observe(spark, "stackoverflow", "id long, title string, score long, answer_count string, tags array<string>", (1, "t", -4, "2", ["reactjs", "ai"])).first()
    assert (q.cantidad_interacciones, q.cantidad_menciones, q.tecnologia_raw) == (0, 3, "reactjs, ai")
    post = observe(spark, "reddit", "id string, url string, score string", ("a", "https://www.reddit.com/r/python/x", "junk")).first()
    assert (post.comunidad_raw, post.tipo_comunidad_raw, post.cantidad_interacciones, post.cantidad_menciones) == ("python", "subreddit", 0, 1)
    news = observe(spark, "gnews", "id string, title string", ("a", "Big story - The Paper")).first()
    assert news.comunidad_raw == "The Paper"
    trend = observe(spark, "google_trends", "agente string, fecha string, valor long", ("Cursor", "2024-01-01", 40)).first()
    assert trend.titulo == "Cursor Trend" and trend.score_popularidad == 40.0 and len(trend.id_origen_registro) == 64
    other = observe(spark, "otra", "name string, link string", ("n", "l")).first()
    assert (other.titulo, other.url, other.plataforma) == ("n", "l", "otra")
    assert list(observe(spark, "arxiv", "id string", ("a",)).columns) == list(contracts.OBSERVATION)


def test_catalog_mapper_indexes(spark):
    schema = "agent string, full_name string, pull_requests_count long, merged_pull_requests long, unique_contributors long, last_activity string, first_activity string, raw_file_id long"
    out = observe(spark, "catalogo", schema, ("Codex", "org/a", 10, 5, 4, None, "2024-02-03T00:00:00Z", 1), ("Codex", "org/b", 4, 4, 1, "2024-03-01", None, 1), ("Codex", "org/c", 0, 0, 0, None, None, 2))
    got = {r.id_origen_registro: r for r in out.collect()}
    a = got["Codex:org/a"]
    assert (a.indice_adopcion, got["Codex:org/b"].indice_adopcion, got["Codex:org/c"].indice_adopcion) == (100.0, 40.0, 0.0)
    assert (a.cantidad_interacciones, a.comunidad_raw, a.fecha_evento_raw) == (19, "org", "2024-02-03T00:00:00Z")


def test_unpivot_hits_and_validation(spark):
    wide = spark.createDataFrame([("2024-01-01", 1, 2, False)], "date string, Cursor long, Codex long, isPartial boolean")
    assert rows_of(mappers.interest_over_time(wide)) == [("2024-01-01", "Codex", 2), ("2024-01-01", "Cursor", 1)]
    hits = spark.createDataFrame([("2", 1690000000, "t", None, None, None), (None, 1, "t", None, None, None)], "objectID string, created_at_i long, title string, url string, points long, num_comments long")
    assert [(r.id, r.points, r.url[-5:]) for r in mappers.search_hits(hits).collect()] == [("2", 0, "?id=2"[-5:])]
    records = spark.createDataFrame([("ab", "cd", "ef", "2024"), ("a", "cd", "ef", None), ("ab", "cd", "ef", "1900")], "nombre_oficial string, empresa string, categoria string, anio string")
    assert [r.is_valid for r in mappers.validated(records).collect()] == [True, False, False]


# landing, staging and sinks


def test_landing_to_staging(spark, tmp_path):
    (tmp_path / "github").mkdir(), (tmp_path / "hackernews").mkdir()
    repos = [{"id": 900001, "name": "codex tool", "created_at": "2025-01-01T00:00:00Z", "stargazers_count": 3}, {"id": 900002, "name": "cursor kit", "created_at": "2025-01-02T00:00:00Z"}, {"id": 1, "name": "noise", "created_at": "2025-01-02"}]
    (tmp_path / "github" / "a.json").write_text(json.dumps({"items": repos}))
    (tmp_path / "github" / "copy.json").write_text(json.dumps({"items": repos}))
    (tmp_path / "hackernews" / "b.json").write_text(json.dumps([{"id": "900003", "title": "windsurf news", "created_at": "2025-02-01", "points": 5}]))
    read = raw.read_json(spark, str(tmp_path), "*.json")
    file_rows, record_rows, rejected = raw.land(read, spark.createDataFrame([], contracts.RAW_FILES), "run-1")
    assert rejected.count() == 0
    assert [(r.fuente, r.registros) for r in file_rows.orderBy("fuente").collect()] == [("github", 3), ("hackernews", 1)]
    assert [d.count() for d in raw.land(read, file_rows, "run-2")] == [0, 0, 0]
    assert [r.ruta for r in file_rows.filter("fuente = 'github'").collect()] == ["github/a.json"]  # of equal files the smallest path
    assert all(r.diferencia == 0 for r in raw.inventory(file_rows, record_rows).collect())
    records = raw.records_of(record_rows, file_rows, file_rows)
    schemas = {"github": "id long, name string, created_at string, stargazers_count long", "hackernews": "id string, title string, created_at string, points long"}
    out = staging.staged(records, schemas)
    assert out.columns == list(contracts.STAGING)
    got = {r.id_origen_registro: (r.nombre_agente, str(r.fecha_evento), r.stars_github, r.cantidad_interacciones) for r in out.collect()}
    assert got == {"900001": ("Codex", "2025-01-01", 3, 0), "900002": ("Cursor Agent", "2025-01-02", 0, 0), "900003": ("Windsurf Cascade", "2025-02-01", 0, 5)}
    staging.semantic_gate(out)


def test_csv_and_optional_inputs(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,\n2,x\n")
    assert [json.loads(r.raw_data) for r in raw.csv_records(spark, str(tmp_path / "a.csv")).collect()] == [{"a": 1, "b": None}, {"a": 2, "b": "x"}]
    assert raw.projected(spark, {}, {"id": "long", "state": "string"}, "reviews").columns == ["id", "state"]


def test_sinks(spark, tmp_path):
    rows = spark.range(5)
    assert sinks.write_catalog(spark, rows, f"{tmp_path}/catalog", 5) == 5 and spark.read.json(f"{tmp_path}/catalog").count() == 5
    with pytest.raises(ValueError):
        sinks.write_catalog(spark, rows, f"{tmp_path}/other", 6)
    sinks.publish(spark, {"t": rows}, str(tmp_path), "r/1", "success")
    sinks.publish(spark, {"t": spark.range(1)}, str(tmp_path), "r2", "failed")
    assert spark.read.csv(f"{tmp_path}/latest/t", header=True).count() == 5 and (tmp_path / "runs" / "r_1" / "_published").exists()


def test_the_written_catalog_is_read_back_in_its_order(spark, sf_dir, monkeypatch):
    """Later parts are larger, so that a scan deals them first."""
    from veleta.registry import runs

    rows = spark.range(400).select((400 - F.col("id")).alias("pull_requests_count"), F.lit("a").alias("agent"), F.lpad(F.col("id").cast("string"), 4, "0").alias("repo_key"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("title"))
    monkeypatch.setattr(runs.gold_queries, "_catalog", lambda *_: (rows, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tuple(runs._catalog_written(spark, sf_dir).first()) == (True, 400, 400, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# star schema, catalog, quality, derived


def test_time_dimension(spark):
    r = gold.time_dimension(spark.sql("select date'2024-12-30' d"), "d").first()
    assert (r.semana, r.dia_semana, r.nombre_dia, r.nombre_mes, r.semestre, r.es_fin_semana) == (1, 1, "Lunes", "Diciembre", 2, False)


def test_agent_dimension(spark):
    df = spark.createDataFrame([("Codex",), (" ",), (rules.OTHER_AGENT,), (None,)], "a string")
    got = {r.nombre_agente: (r.proveedor, r.es_agente_identificado) for r in gold.agent_dimension(df, "a").collect()}
    assert got == {"Codex": ("OpenAI", True), "No especificado": ("No especificado", False), rules.OTHER_AGENT: ("No especificado", False)}


def pull_request_tables(spark):
    prs = spark.createDataFrame(
        [(1, "One", "Google_Jules", 7, None, "org/repo", "h1", "2026-12-31T23:59:59Z", "2027-01-01T00:00:00Z"), (2, "Two", "Google Jules", 8, 10, "org/repo", "h2", "2025-02-01T00:00:00Z", None), (3, "Outside", "Google_Jules", 7, 10, "org/repo", "h3", "2027-01-01T00:00:00Z", None)],
        "id long, title string, agent string, user_id long, repo_id long, repo_url string, html_url string, created_at string, merged_at string",
    )
    repos = spark.createDataFrame([(10, "org/repo", "MIT", "org/repo", "Python", 2, 3)], "id long, url string, license string, full_name string, language string, forks long, stars long")
    users = spark.createDataFrame([(7.0,), (None,)], "id double")
    reviews = spark.createDataFrame([(11, 1, "APPROVED", "User"), (12, 1, "COMMENTED", "Bot"), (13, 1, "CHANGES_REQUESTED", "User")], "id long, pr_id long, state string, user_type string")
    tasks = spark.createDataFrame([(1, "feat", 9.0), (2, "fix", 7.0)], "id long, type string, confidence double")
    return prs, repos, users, reviews, tasks


@pytest.mark.parametrize("copies", [1, 2])
def test_catalog(spark, copies):
    prs, repos, users, reviews, tasks = (t if copies == 1 else t.unionByName(t.limit(1)) for t in pull_request_tables(spark))
    repos = catalog.repositories(repos)
    kept = catalog.pull_requests(prs, repos, {"Google_Jules": "Google Jules"}, ["Google Jules"], "2023-01-01", "2026-12-31")
    rows = catalog.records(catalog.catalog(kept, repos, reviews, tasks, users), 1, "d").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.agent, r.repo_id, r.pull_requests_count, r.merged_pull_requests, r.merge_rate, r.last_activity) == ("Google Jules", 10, 2, 1, 0.5, "2026-12-31T23:59:59Z")
    assert (r.review_count, r.human_review_count, r.bot_review_count, r.approved_review_count, r.changes_requested_review_count, r.reviewed_pull_requests) == (3, 2, 1, 1, 1, 1)
    assert (r.known_contributors, r.unique_contributors, r.task_type_counts, r.task_confidence_mean, r.stars) == (1, 2, {"feat": 1, "fix": 1}, 8.0, 3)
    annual = catalog.pull_requests(prs, repos, {"Google_Jules": "Google Jules"}, ["Google Jules"], "2023-01-01", "2026-12-31", annual=True)
    assert sorted(x.repo_key for x in annual.collect()) == ["id:10:year:2025", "id:10:year:2026"]
    assert catalog.pull_requests(prs, repos, {"Google_Jules": "Google Jules"}, ["Google Jules"], "2023-01-01", "2026-12-31", most=0).count() == 0
    with pytest.raises(ValueError):
        catalog.pull_requests(prs, repos, {}, None, "2023-01-01", "2026-12-31", most=-1)


def test_reconcile(spark):
    df = spark.createDataFrame([(10, 8, 2, 5), (0, 0, 0, 0), (3, 0, 0, 0)], "raw long, eligible long, duplicates long, materialized long")
    got = [(r.expected_staging_records, r.load_error_records, r.completion_rate, r.overall_error_rate, r.deduplication_rate) for r in quality.reconcile(df).collect()]
    assert got == [(6, 1, 83.33, 16.67, 25.0), (0, 0, 0.0, 0.0, 0.0), (0, 0, 100.0, 0.0, 0.0)]


def outcomes(spark, *rows):
    return spark.createDataFrame(list(rows), contracts.OUTCOMES.replace("timestamp", "timestamp")).withColumn("execution_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_freshness_and_status(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    r = quality.freshness(outcomes(spark, ("s", "q", "empty", 0, None)), now).first()
    assert (r.latest_status, r.age_hours, r.is_stale, r.expected_queries, r.completed_queries) == ("empty", 0.0, False, 1, 1)
    failed = quality.freshness(outcomes(spark, ("s", "q", "failed", 0, None)), now).first()
    assert failed.is_stale and failed.last_success_at is None
    cases = [([], "empty"), (["empty"], "empty"), (["failed"], "failed"), (["success", "empty"], "success"), (["success", "failed"], "partial_success"), (["partial_success", "success"], "partial_success")]
    for statuses, want in cases:
        assert quality.run_status(outcomes(spark, *[("s", "q", s, 0, None) for s in statuses])).first().status == want
    assert quality.run_status(outcomes(spark, ("s", "q", "failed", 100, None))).first().status == "partial_success"
    assert quality.run_status(outcomes(spark, ("s", "q", "success", 1, None)), critical=True).first().status == "failed"
    runs = spark.createDataFrame([(0, 0, "success"), (0, 0, "failed"), (3, 1, "success"), (3, 0, "success")], "raw long, load_errors long, requested string")
    assert [r.status for r in quality.publication_status(runs).collect()] == ["empty", "failed", "failed", "success"]


def test_run_resolution(spark):
    files = spark.createDataFrame([("github", "r1", "2024-01-01"), ("github", "r2", "2024-01-02"), ("hackernews", "r2", "2024-01-02"), ("hackernews", "r3", "2024-01-03")], "fuente string, run_id string, fecha_carga string")
    assert quality.resolve_run(files, ["github", "hackernews"]) == "r3"
    assert quality.resolve_run(files, ["github"], "r2", mixed=True) == "r2"
    for bad in ("r2", "r9"):
        with pytest.raises(ValueError):
            quality.resolve_run(files, ["github"], bad)


def test_sample_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(i, "github", "Cursor" if i < 4 else "Codex") for i in range(1, 6)], "id long, fuente string, agente string")
    take = lambda d: rows_of(quality.stratified_sample(d, "fuente", "agente", F.col("id"), "seed", 1).select("id"))
    assert len(take(df)) == 2 and take(df) == take(df.orderBy(F.rand(3)))


def test_quadrants(spark):
    df = spark.createDataFrame([("A", "0", "9", 1.0), ("B", "9", "9", float("inf")), ("C", "9", "0", 1.0), ("D", "0", "0", 1.0), ("E", None, "1", 1.0), ("F", "invalid", "1", 1.0), ("G", "-1", "1", 1.0)], "nombre_agente string, adopcion string, popularidad string, total_observaciones double")
    got = {r.nombre_agente: (r.cuadrante, r.volumen_log) for r in derived.quadrants(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {"A": "populares", "B": "lideres", "C": "adoptados", "D": "emergentes"} and got["B"][1] == 0.0


def test_top_and_others(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(1, 9)], "k string, n long")
    got = dict(rows_of(measures.top_and_others(df, "k", "n", 6)))
    assert got["Otros"] == 3 and len(got) == 7


# streams


def test_upsert_stream(spark, tmp_path):
    source, schema = tmp_path / "in", "k string, v long, t string"
    source.mkdir()
    table = incremental.VersionedTable(spark, str(tmp_path / "table"), schema, ["k"])

    def run():
        q = incremental.upsert_stream(incremental.landing(spark, str(source), schema), table, ["v"], str(tmp_path / "ck"))
        q.awaitTermination(120)

    (source / "1.json").write_text('{"k":"a","v":2,"t":"x"}\n{"k":"b","v":1,"t":"x"}\n')
    run()
    (source / "2.json").write_text('{"k":"a","v":1,"t":"late"}\n{"k":"b","v":3,"t":"y"}\n')
    run()
    run()  # nothing new
    assert rows_of(table.current()) == [("a", 2, "x"), ("b", 3, "y")]


def test_freshness_stream(spark, tmp_path):
    spark.createDataFrame([("s", "q", "success", 2), ("s", "q", "failed", 0)], "source string, query string, status string, records_extracted long").coalesce(1).withColumn(
        "execution_timestamp", F.timestamp_seconds(F.when(F.col("status") == "failed", 200).otherwise(100))
    ).write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(contracts.OUTCOMES).parquet(f"{tmp_path}/events")
    q = incremental.freshness_stream(stream).writeStream.outputMode("complete").format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination(120)
    r = spark.table("fresh").first()
    assert (r.latest_status, r.records_extracted) == ("failed", 2) and r.last_success_at < r.last_attempt_at
