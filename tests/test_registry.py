"""Every registered query against its SQL on the small tables."""

from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from veleta import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(frame, columns):
    def cell(v):
        if pd.isna(v):
            return "NULL"
        if not isinstance(v, (bool, np.bool_)) and isinstance(v, (int, float, np.number, Decimal)):
            return f"{float(v):.6f}"
        return str(v).removesuffix(" 00:00:00")

    return sorted(tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got, sorted(got.columns)) == plain(want, sorted(want.columns))
