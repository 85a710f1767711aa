"""Every raster and catalogue query against its SQL."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import DATA

from terrazzo import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
SLOW = {"overlap_match_tree", "overlap_transforms", "transform_quality"}


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    return sorted(repr(tuple(None if pd.isna(v) else float(v) if isinstance(v, int | float) and not isinstance(v, bool) else v for v in r)) for r in df.values.tolist())


@pytest.mark.parametrize("name", [n for n in ORACLES if n not in SLOW])
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_pansharpening_of_more_than_one_tile(spark, duck, tmp_path):
    """Half of the rows lie below the first 2,048 lines of pan; they count in the statistics."""
    own = spark.read.parquet(f"{DATA}/embeddings.parquet").selectExpr("vec_id + if(vec_id >= 252, 12288, 0) as vec_id", "embedding")
    own.write.parquet(str(tmp_path / "embeddings.parquet"))
    other = duck.cursor()
    other.sql(f"create temp view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    got, want = QUERIES["pansharpen"](spark, str(tmp_path)).toPandas(), other.sql(ORACLES["pansharpen"]).df()
    assert got.y.max() >= 2048
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 3384  # FIXTURES.md, 4
    assert set(e.oracle_sql()) <= set(e.queries())
