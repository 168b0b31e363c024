"""Tables that change in one step, and buckets that grow."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veleta import tables
from veleta.streaming import incremental


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_buckets_follow_the_table(spark, tmp_path):
    schema = "k string, v long"
    table = incremental.VersionedTable(spark, str(tmp_path / "t"), schema, ["k"], rows_per_bucket=50)
    rows = lambda n, v: spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(v).cast("long").alias("v"))
    table.merge(rows(80, 1), ["v"])
    assert list(table.directory()) == [(0, 0)]
    table.merge(rows(4000, 2), ["v"])
    table.merge(rows(4000, 1), ["v"])  # older: changes nothing, replayed or not
    table.merge(rows(4000, 1), ["v"])
    buckets = table.directory()
    assert 40 <= len(buckets) <= 160 and sum(b["rows"] for b in buckets.values()) == 4000
    assert max(b["rows"] for b in buckets.values()) <= 100
    assert rows_of(table.current().groupBy("v").count()) == [(2, 4000)]
    assert sorted(r.k for r in table.current().collect()) == sorted(f"k{i}" for i in range(4000))


def test_the_log_is_folded(spark, tmp_path, monkeypatch):
    """Many small batches: lines that are read stay below twice the buckets."""
    table = incremental.VersionedTable(spark, str(tmp_path / "t"), "k long, v long", ["k"], rows_per_bucket=20)
    monkeypatch.setattr(table, "MOST_FILES", 8)
    every = lambda i: spark.range(200).select(F.col("id").alias("k"), F.lit(i).cast("long").alias("v"))
    table.merge(every(0), ["v"])
    for i in range(1, 21):
        table.merge(every(i).filter(f"k % 50 = {i}"), ["v"])
        assert len(table.log_lines()) <= 2 * len(table.directory()) and len(table.log_files()) <= 8
    got = {r.k: r.v for r in table.current().collect()}
    assert got == {k: k % 50 if 1 <= k % 50 <= 20 else 0 for k in range(200)}


def test_a_broken_batch_leaves_the_table_and_no_rest(spark, tmp_path, monkeypatch):
    table = incremental.VersionedTable(spark, str(tmp_path / "t"), "k string, v long", ["k"], rows_per_bucket=5)
    make = lambda *r: spark.createDataFrame(list(r), "k string, v long")
    table.merge(make(*[(f"k{i}", 1) for i in range(30)], (None, 1), ("N/A", 2)), ["v"])  # missing keys are one key
    before, versions = rows_of(table.current()), set(tables.children(spark, str(tmp_path / "t" / "data")))
    with monkeypatch.context() as m:
        m.setattr(tables, "put_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge(make(("k1", 9)), ["v"])
    assert rows_of(table.current()) == before and len(before) == 31
    assert len(tables.children(spark, str(tmp_path / "t" / "data"))) == len(versions) + 1
    table.merge(make(("k2", 9)), ["v"])
    assert len(tables.children(spark, str(tmp_path / "t" / "data"))) <= len(versions) + 1
    assert rows_of(table.current().filter("v = 9")) == [("k2", 9)] and table.current().count() == 31


def test_snapshots_change_all_tables_in_one_step(spark, tmp_path):
    store = tables.Snapshots(spark, str(tmp_path / "s"))
    assert store.state() == {} and not store.has("a")
    one = store.publish({"a": spark.range(3), "b": spark.range(5).withColumn("p", F.col("id") % 2)}, {"b": ["p"]})
    assert (store.read("a").count(), store.read("b").filter("p = 1").count()) == (3, 2)
    with pytest.raises(Exception, match="lost"):  # the first table is written, the second one breaks
        store.publish({"a": spark.range(7), "b": spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))})
    assert (store.read("a").count(), store.read("b").count()) == (3, 5)
    store.publish({"a": store.read("a").union(spark.range(10, 12))})
    assert (store.read("a").count(), store.read("b").count(), store.read("a", one).count()) == (5, 5, 3)
    for _ in range(3):
        store.publish({"a": store.read("a")})
    assert len(store.numbers()) == 3 and len(tables.children(spark, str(tmp_path / "s" / "a"))) == 3 and store.read("b").count() == 5


def test_a_run_is_replaced_in_all_its_tables(spark, tmp_path):
    schemas = {"x": "run_id string, n long", "y": "run_id string, n long", "z": "run_id string, t string"}
    store = tables.RunTables(spark, str(tmp_path / "r"), schemas)
    rows = lambda run, *n: spark.createDataFrame([(run, i) for i in n], schemas["x"])
    assert store.read("x").count() == 0
    text = spark.createDataFrame([("r/1", "t")], schemas["z"])
    store.persist("r/1", {"x": rows("r/1", 1, 2), "y": rows("r/1", 3), "z": text})
    store.persist("r2", {"x": rows("r2", 9), "y": rows("r2", 9)})
    store.persist("r/1", {"x": rows("r/1", 5), "y": rows("r/1"), "z": text.limit(0)})  # now empty in two of them
    assert [rows_of(store.read(t)) for t in "xyz"] == [[("r/1", 5), ("r2", 9)], [("r2", 9)], []]
    with pytest.raises(Exception, match="not of run"):
        store.persist("r2", {"x": rows("other", 1)})
    assert rows_of(store.read("x")) == [("r/1", 5), ("r2", 9)]


def test_versions_under_a_widened_schema(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, t string").write.parquet(f"{tmp_path}/v1")
    spark.createDataFrame([(2, None, None, 0.5), (3, "b", "x", None)], "id long, t string, metodo string, score double").write.parquet(f"{tmp_path}/v2")
    wide = tables.read_widened(spark, [f"{tmp_path}/v1", f"{tmp_path}/v2"], {"id": "long", "t": "string", "metodo": "string", "score": "double", "new": "long"}, {"metodo": "regla", "new": 0})
    assert wide.dtypes == [("id", "bigint"), ("t", "string"), ("metodo", "string"), ("score", "double"), ("new", "bigint")]
    assert sorted(map(str, wide.collect())) == sorted(map(str, [r for r in spark.createDataFrame([(1, "a", "regla", None, 0), (2, None, None, 0.5, 0), (3, "b", "x", None, 0)], wide.schema).collect()]))


def test_a_date_condition_prunes_the_partitions_of_the_fact(spark, sf_dir):
    from veleta.plans import star
    from veleta.registry import runs

    snapshots = runs._star(spark, sf_dir)
    some = star.activity(snapshots, ["nombre_fuente", "cantidad_menciones"], "1995-01-01", "1995-03-31")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "dim_agente" not in plan
    dates = star.activity(snapshots, ["fecha_evento"])
    assert some.count() == dates.filter("fecha_evento between '1995-01-01' and '1995-03-31'").count() > 0


def test_a_star_loaded_in_parts_reports_alike(spark, sf_dir, monkeypatch):
    """Several parts and slices, each written with its shuffles removed after it, give the report that one gives."""
    from veleta import scratch
    from veleta.operators import keys
    from veleta.registry import runs

    report, ways = lambda: rows_of(runs.QUERIES["star_source_share"](spark, sf_dir)), []
    want, before = report(), spark.conf.get(scratch._CLEANUP)
    monkeypatch.setattr(keys, "SLICE_ROWS", 1500)

    def seen(parts):
        for df in parts:
            ways[-1].append(spark.conf.get(scratch._CLEANUP))
            yield df

    def watched(spark, parts, name, *more, kept=scratch.keep_parts):
        ways.append([name])
        return kept(spark, seen(parts), name, *more)

    for module in (keys, runs.gold):
        monkeypatch.setattr(module, "keep_parts", watched)
    assert report() == want and spark.conf.get(scratch._CLEANUP) == before
    assert all(set(w[1:]) == {"true"} for w in ways) and {w[0]: len(w) - 1 for w in ways if len(w) > 4}.keys() == {"staging", "numbered"}
