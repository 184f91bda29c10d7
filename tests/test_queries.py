"""Every query with SQL against DuckDB, and the others for rows."""

import math

import duckdb
import pytest

from maskframe.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    names, kinds = [d[0] for d in result.description], [str(d[1]) for d in result.description]
    assert sorted(names) == columns and not any("HUGEINT" in k for k in kinds)
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)


def parts(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["volume_relationships", "nucleus_matching", "compartments", "plane_ids", "mask_overlaps", "hull_shape", "intensity_measurements", "spot_refinement"])
def test_no_table_made_of_pixels_is_broadcast(spark, data, name):
    """Spark takes what a generator makes for as small as what it is made of."""
    plan = parts(QUERIES[name](spark, data))
    assert plan.count("BroadcastExchange") == plan.count("/nation.parquet]") + plan.count("/region.parquet]")


@pytest.mark.parametrize("name", ["nearest_seed_expansion", "perimeter_and_circularity", "surface_areas", "moment_shape", "euler_and_crofton", "overlap_counts", "polygon_labels", "points_to_labels", "bilinear_shrink", "binomial_smooth"])
def test_pixels_are_dealt_by_image_once(spark, data, monkeypatch, name):
    """However many images there are, a task makes and holds so many of them, and what it makes isn't shuffled again."""
    from maskframe.sources import raster

    monkeypatch.setattr(raster, "IMAGES_AT_ONCE", 2)
    plan = parts(QUERIES[name](spark, data))
    assert "ENSURE_REQUIREMENTS" not in plan.replace("BroadcastExchange", "") and "Exchange hashpartitioning(image_id" in plan
    assert ", 5), REPARTITION_BY_NUM" in plan
