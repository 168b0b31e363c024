"""Exact order statistics, distinct counts in two levels, and literals of patterns."""

from __future__ import annotations

import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from veleta.operators import measures, quantiles, rules


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0], [4.0, 1.0, 3.0, 2.0], [5.0] * 9, [0.0], [-1.5, -1.5, 7.0, 7.0], [1e-300, 1e300, 2e-300, -1e300, 5.0],
        [1.0 + 2**-52 * i for i in range(50)], [5e-324, 1e-323, 0.0, 1.5e-323], [-1.7e308, 1.7e308], [-math.inf, 1.0, math.inf, 2.0],
    ],
)
def test_medians(spark, values):
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "x double, none double")
    want = statistics.median_low(values) / 2 + statistics.median_high(values) / 2 if len(values) % 2 == 0 else statistics.median(values)
    assert quantiles.medians(df, ["x", "none"]) == {"x": want, "none": None}


def test_order_statistics_of_many_values(spark):
    draw = random.Random(2)
    values = [draw.choice([draw.gauss(0, 1), round(draw.gauss(0, 5)), draw.expovariate(1e-6)]) for _ in range(3000)] + [float("nan")] * 3
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)], "v double, i int")
    ordered = sorted(v for v in values if v == v)
    places = [0, 1, 7, 1500, 2998, 2999]
    got = quantiles.order_statistics(df, {"v": places, "i": [5]})
    assert got == {"v": [ordered[p] for p in places], "i": [5.0]}
    assert math.isnan(quantiles.order_statistics(df, {"v": [3001]})["v"][0])  # NaN counts as the greatest
    with pytest.raises(ValueError):
        quantiles.order_statistics(df, {"v": [3003]})


def test_distinct_counts_do_not_multiply_rows(spark):
    rows = [("a", 1, "x", 2), ("a", 1, None, 3), ("b", 2, "y", None), ("b", None, "x", 1), (None, 1, None, 1), ("a", 1, "x", 5)]
    df = spark.createDataFrame(rows, "g string, n int, t string, v int")
    sums = [("filas", F.count(F.lit(1)), "sum"), ("v", F.sum("v"), "sum"), ("primero", F.min("v"), "min")]
    out = measures.with_distinct_counts(df, ["g"], {"ns": "n", "ts": "t"}, sums)
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("filas"), F.sum("v").alias("v"), F.min("v").alias("primero"), F.count_distinct("n").alias("ns"), F.count_distinct("t").alias("ts"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    one = measures.with_distinct_counts(df, [], {"ns": "n", "ts": "t"}, sums).first()
    assert (one.filas, one.v, one.primero, one.ns, one.ts) == (6, 12, 1, 2, 2)
    none = measures.union_counts(df.limit(0), {"ns": "n"})
    assert sorted(map(tuple, none.collect())) == [("filas", 0), ("ns", 0)]


def test_literals_of_patterns():
    assert rules.literals(r"vs[ -]?code|visual studio code") == ["code", "visual studio code"]
    assert rules.literals(r"\breact(?:js)?\b") == ["react"] and rules.literals(r"c\+\+|\bcs\.ai\b") == ["c++", "cs.ai"]
    assert rules.literals(r"\btests?\b|ab{2,3}cd") == ["test", "cd"] and rules.literals(r"x|(?:a|b)") == []
    draw = random.Random(3)
    words = ["React", "reactjs", "VS-Code", "vscode", "aws lambda", "AWS", "c++", "ıntellij", "K8S", "clİ", "api", "r", "R;", "Go", "node.js", "depuraciÓn", "x", "tests"]
    for _ in range(2000):
        text = "".join(draw.choice(words) + draw.choice([" ", "", ",", "-"]) for _ in range(draw.randrange(5)))
        hay = text.replace("İ", "i").upper().lower()
        for *_, pattern in (*rules.PLATFORM_RULES, *rules.TECHNOLOGY_RULES):
            needed = rules.literals(pattern)
            assert needed
            if re.search(pattern, text, re.IGNORECASE):
                assert any(n in hay for n in needed), (pattern, text)


def test_first_rules_are_the_same_with_and_without_literals(spark):
    texts = ["VS Code and docker", "a CLI tool", "clİ", "", None, "uses RAG, react.js", "K8S on aws lambda", "no rule", "Ünïcode depuraciÓn", "js/r;sql", "GITHUB ACTIONS"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for table in (rules.PLATFORM_RULES, rules.TECHNOLOGY_RULES):
        plain = rules.first_match(F.col("t"), table, ("name", "kind", "more"))["name"]
        quick = rules.rule_values(rules.first_number(F.col("t"), table), table, ("name",))[0]
        got = df.select("t", plain.alias("a"), quick.alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]
