"""Every query with SQL gives the same rows as the independent engine on the smallest tables."""

import glob
import itertools
import math
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagecraft.functions import scalars as sc
from pagecraft.operators import palette
from pagecraft.plans import fixtures as fx
from pagecraft.plans import oracle, registry

from .conftest import DATA


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(pdf, cols):
    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "nan", "None"):
            return None
        try:
            return round(float(v), 5)
        except (TypeError, ValueError):
            return str(v)

    return Counter(tuple(norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, DATA).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    assert len(ours) > 0
    assert rows(ours, cols) == rows(theirs, cols)


def test_colours_of_luma_128_are_not_dark(spark, duck):
    """Colours whose luma is 128, or a hair beside it, by the query and by its SQL."""
    hexes = [f"#{r:02x}{g:02x}{b:02x}" for r in range(256) for g in range(256) for b in range(0, 256, 5) if 299 * r + 587 * g + 114 * b == 128_000]
    ours = spark.createDataFrame([(h,) for h in hexes], "hex string").select("hex", sc.is_dark(F.col("hex")).alias("dark")).toPandas()
    sql = registry.ORACLE_SQL["color_scalars"].replace(fx.COLOURS_SQL, "rgb AS (SELECT hex, ('0x' || hex[2:3])::INTEGER AS r, ('0x' || hex[4:5])::INTEGER AS g, ('0x' || hex[6:7])::INTEGER AS b FROM painted)")
    duck.register("painted", ours[["hex"]])
    theirs = duck.sql(f"SELECT hex, dark FROM ({sql})").df()
    assert "#66889b" in hexes
    assert dict(ours.itertuples(index=False)) == dict(theirs.itertuples(index=False))


def test_surfaces_at_the_edge_of_nearness(spark, duck):
    """Two colours whose lumas are 76.5 apart, 0.3 of the scale, or a hair beside it, by the query and by its SQL."""
    by_luma = {}
    for r, g, b in itertools.product(range(0, 256, 6), range(0, 256, 6), range(0, 256, 10)):
        by_luma.setdefault(299 * r + 587 * g + 114 * b, f"#{r:02x}{g:02x}{b:02x}")
    pairs = [(h, by_luma[k + 76_500]) for k, h in by_luma.items() if k + 76_500 in by_luma]
    none = F.array().cast("array<string>")
    palettes = spark.createDataFrame([(i, list(p)) for i, p in enumerate(pairs)], "comp_id long, colours array<string>")
    palettes = palettes.withColumns({"texts": none, "accents": none, "dark_perceived": F.when(F.col("comp_id") % 5 == 0, F.col("comp_id") % 2 == 0)})
    ours = palette.roles(palettes).select("comp_id", "surface").toPandas()
    duck.register("listed", pd.DataFrame([(i, h, k + 1) for i, p in enumerate(pairs) for k, h in enumerate(p)], columns=["comp_id", "hex", "rank"]))
    sql = registry.ORACLE_SQL["palette_roles"].replace(oracle.TOP_SQL, "top AS (SELECT * FROM listed), colour AS (SELECT comp_id, hex, 0 AS ord FROM listed WHERE false)")
    theirs = duck.sql(f"SELECT comp_id, surface FROM ({sql})").df()
    assert len(pairs) > 100
    assert dict(ours.itertuples(index=False)) == dict(theirs.itertuples(index=False))
