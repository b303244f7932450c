"""Every query that has SQL gives its rows."""

import duckdb
import pandas as pd
import pytest
from tallyspark.plans.adapters import adapter
from tallyspark.plans.queries import QUERIES, SQL

import __spark_entry__

TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    def plain(x) -> str:
        if x is None or x is pd.NA or x is pd.NaT or x != x:
            return ""
        if hasattr(x, "year"):
            return str(pd.Timestamp(x))
        if isinstance(x, float):
            return str(int(x)) if x == int(x) else repr(x)
        return str(x)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.mark.parametrize("name", ["videos", "corrections"])
def test_adapters_read_all_lines(spark, sf, name):
    assert adapter(spark, sf, name).count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_ingest_keeps_all_meetings(spark, sf):
    assert "meetings_ingest" in SQL
    assert QUERIES["meetings_ingest"](spark, sf).count() == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_gap_fill_fills(spark, sf):
    """The spread of the videos' days leaves days of one video among the meetings'."""
    before = adapter(spark, sf, "meetings").filter("video_url IS NULL").count()
    assert QUERIES["gap_fill"](spark, sf).filter("video_url IS NULL").count() < before


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
