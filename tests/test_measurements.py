"""The measurement tables as a SQL surface, and invariants over all of them."""

import pytest

from maskframe.plans import measurements
from maskframe.plans.snapshots import Conflict, Snapshots
from maskframe.sources import raster


@pytest.fixture(scope="module")
def surface(spark, data, tmp_path_factory):
    """Published tables, so that no test measures them again."""
    out = f"file://{tmp_path_factory.mktemp('surface')}/run"
    measurements.publish(spark, data, out)
    measurements.opened(spark, out)
    return spark


def test_registered_tables_measure_what_is_asked(surface, data):
    known = sorted(map(tuple, surface.sql("SELECT object_id, image_id, timepoint, label_value, voxel_count FROM objects").collect()))
    views = {n: surface.table(n) for n in measurements.COLUMNS}
    measurements.register(surface, data)
    assert sorted(map(tuple, surface.sql("SELECT object_id, image_id, timepoint, label_value, voxel_count FROM objects").collect())) == known
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    measurements.register_views(surface)


def test_tables_and_views_are_there(surface):
    names = {r.viewName for r in surface.sql("SHOW VIEWS").collect()}
    assert {"images", "channels", "label_sets", "objects", "intensity_measurements", "relationships", "schema_info", "measurement_runs", *measurements.VIEWS} <= names
    assert {"object_id", "voxel_count", "area_um2"} <= {r.col_name for r in surface.sql("DESCRIBE objects").collect()}


def test_invariants(surface, data):
    one = lambda text: surface.sql(text).first()[0]
    assert one("SELECT sum(voxel_count) FROM objects") == raster.labels(surface, data).count()
    assert one("SELECT count(*) FROM intensity_measurements") == 2 * one("SELECT count(*) FROM objects")
    assert one("SELECT count(*) FROM relationships a LEFT ANTI JOIN relationships b ON a.source_object_id = b.target_object_id AND a.target_object_id = b.source_object_id AND a.overlap_voxels = b.overlap_voxels") == 0
    assert one("SELECT count(*) FROM relationships WHERE source_overlap_fraction <= 0 OR source_overlap_fraction > 1") == 0
    assert one("SELECT count(*) FROM (SELECT relationship_id FROM relationships GROUP BY 1 HAVING count(*) > 1)") == 0
    assert one("SELECT count(*) FROM objects WHERE is_point AND bbox_min_y_px IS NOT NULL") == 0
    assert one("SELECT count(*) FROM objects o JOIN images i USING (image_id) WHERE i.scale_y_um IS NULL AND o.area_um2 IS NOT NULL") == 0
    assert one("SELECT count(*) FROM relationships r JOIN label_sets s ON s.label_set_id = r.source_label_set_id JOIN label_sets t ON t.label_set_id = r.target_label_set_id WHERE s.object_type = 'cytoplasm' AND t.object_type = 'nuclei'") == 0


def test_columns_are_whole(surface):
    for name, columns in measurements.COLUMNS.items():
        assert surface.table(name).dtypes == [(c.split(" ")[0], {"long": "bigint"}.get(c.split(" ")[1], c.split(" ")[1])) for c in columns.split(", ")]
    assert [len(c.split(", ")) for c in measurements.COLUMNS.values()] == [2, 8, 19, 5, 7, 60, 16, 16]
    filled = surface.sql("SELECT " + ", ".join(f"count({c}) AS {c}" for c in surface.table("objects").columns) + " FROM objects").first().asDict()
    # the raster's images are flat: all but the features of volumes are there
    assert {c for c, n in filled.items() if n == 0} == {"volume_voxels", "volume_um3", "convex_volume_voxels", "convex_volume_um3", "filled_volume_voxels", "filled_volume_um3", "surface_area_um2", "sphericity"}


def test_ids_are_dense_and_apart(surface):
    one = lambda text: surface.sql(text).first()[0]
    assert measurements.violations(surface).filter("violations > 0").count() == 0
    assert one("SELECT max(object_id) - count(*) FROM objects") == 0 and one("SELECT min(relationship_id) FROM relationships") == 1


def test_ids_of_many_sets_and_large_labels(spark):
    labels = spark.createDataFrame([(1, t, s, k, 0, k % 7, s % 9) for t in (0, 1) for s in (1, 2, 11, 12) for k in (1, 2, 100_001, 100_002, 2**40)], "image_id long, t int, set_index int, label long, z long, y long, x long")
    images = spark.createDataFrame([(1, 1.0, 1.0)], "image_id long, scale_y double, scale_x double")
    rows = measurements.object_rows(labels, images, {1: "a", 2: "b", 11: "c", 12: "d"}, []).collect()
    assert sorted(r.object_id for r in rows) == list(range(1, 41)) and len({r.label_set_id for r in rows}) == 4
    assert sorted(rows, key=lambda r: r.object_id) == sorted(rows, key=lambda r: (r.image_id, r.t, r.set_index, r.label))
    with pytest.raises(Exception, match="out of range"):
        measurements.object_rows(labels.withColumn("set_index", labels["set_index"] + 70_000), images, {1: "a"}, []).select("label_set_id").collect()


def test_publishing(surface, data, tmp_path):
    out = f"file://{tmp_path}/run"
    with pytest.raises(ValueError, match="isn't whole"):
        measurements.opened(surface, out)
    assert measurements.publish(surface, data, out) == 1
    store = Snapshots(surface, out)
    assert store.named().keys() == measurements.COLUMNS.keys() and store.table("objects").count() == surface.table("objects").count()
    before = sorted(map(tuple, surface.sql("SELECT * FROM foci_assignments").collect()))
    measurements.opened(surface, out)
    assert sorted(map(tuple, surface.sql("SELECT * FROM foci_assignments").collect())) == before and before
    with pytest.raises(Conflict, match="exist"):
        measurements.publish(surface, data, out)


def test_a_run_that_dies_can_be_repeated(surface, data, tmp_path, monkeypatch):
    """Killed between two tables: readers see the old version meanwhile, and the repeated run gives what an undisturbed one does."""
    out = f"file://{tmp_path}/run"
    only = {"label_sets", "channels"}
    measurements.publish(surface, data, out, only)
    store, write = Snapshots(surface, out), Snapshots.written
    old = store.named()

    def dies(self, name, df):
        if name == "label_sets":
            raise OSError("lost")
        return write(self, name, df)

    monkeypatch.setattr(Snapshots, "written", dies)
    with pytest.raises(OSError, match="lost"):
        measurements.publish(surface, data, out, only, replace=True, moments_only=True)
    assert store.latest() == 1 and store.named() == old and store.table("label_sets").count() > 0
    monkeypatch.setattr(Snapshots, "written", write)
    reader = store.table("label_sets")
    assert measurements.publish(surface, data, out, only, replace=True, moments_only=True) == 2
    assert sorted(map(tuple, store.table("label_sets").collect())) == sorted(map(tuple, reader.collect())) == sorted(map(tuple, store.table("label_sets", 1).collect()))
    gone = store.swept()
    assert store.versions() == [2] and len(gone) >= 4 and store.table("channels").count() > 0
    with pytest.raises(ValueError, match="no version 1"):
        store.named(1)


def test_commits_of_several_writers(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}/store")
    rows = lambda n: spark.range(n)
    assert store.latest() == 0 and store.named() == {} and store.commit({"a": store.written("a", rows(1))}) == 1
    base = store.latest()
    assert store.commit({"b": store.written("b", rows(2))}, base) == 2
    # another's tables between leave a commit be; its own don't
    assert store.commit({"a": store.written("a", rows(3))}, base) == 3
    with pytest.raises(Conflict, match="a of"):
        store.commit({"a": store.written("a", rows(4))}, base)
    assert {n: store.table(n).count() for n in store.named()} == {"a": 3, "b": 2} and store.table("a", 1).count() == 1
    # of two that want one number, one gets it
    assert not store.put(3, {}) and store.versions() == [1, 2, 3] and store.named() == store.named(3)


def test_queries_over_a_run_leave_the_sessions_views_alone(spark, data, tmp_path):
    import shutil

    spark.range(3).createOrReplaceTempView("objects")
    folder = tmp_path / "sf"
    shutil.copytree(data, folder)
    shown = lambda: spark.sql(measurements.over_published(spark, str(folder), "SELECT count(*), max(object_id) FROM objects o WHERE area_um2 > 0")).first()
    first = shown()
    assert first[0] > 0 and spark.table("objects").count() == 3
    # other input under the same folder gives another run
    spark.read.parquet(f"{data}/supplier.parquet").filter("s_suppkey <= 3").coalesce(1).write.mode("overwrite").parquet(f"{folder}/few")
    (folder / "supplier.parquet").unlink()
    (folder / "few").rename(folder / "supplier.parquet")
    assert 0 < shown()[0] < first[0]
    measurements.forgotten(spark)
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("maskframe_")] and spark.table("objects").count() == 3
    spark.catalog.dropTempView("objects")


def test_statistics(spark, data, tmp_path):
    out = f"file://{tmp_path}/run"
    measurements.publish(spark, data, out)
    try:
        for name in measurements.COLUMNS:
            spark.catalog.dropTempView(name)
        measurements.opened(spark, out, statistics=True)
        told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED objects").collect()}
        assert f"{spark.table('objects').count()} rows" in told["Statistics"]
    finally:
        for name in measurements.COLUMNS:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables_laid_out_by_image_meet_without_a_shuffle(spark, data, tmp_path):
    out = f"file://{tmp_path}/run"
    measurements.publish(spark, data, out, moments_only=True)
    measurements.opened(spark, out)
    shown = {v: sorted(map(tuple, spark.table(v).collect()), key=repr) for v in ("mask_relationships", "object_features", "foci_assignments")}
    for name in measurements.COLUMNS:
        spark.catalog.dropTempView(name)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    spark.sql("CREATE DATABASE IF NOT EXISTS laid_out")
    try:
        measurements.laid_out(spark, out, 4, database="laid_out")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for view, rows in shown.items():
            df = spark.table(view)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" in plan, (view, plan)
            assert sorted(map(tuple, df.collect()), key=repr) == rows
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("USE default")
        spark.sql("DROP DATABASE laid_out CASCADE")


def test_sets_hold_places_if_any_timepoint_says_so(spark, data):
    told = [(i, 4, t, v) for i, values in {1: (True, False), 2: (False, False), 3: (None, True)}.items() for t, v in enumerate(values)] + [(1, 1, 0, True)]
    told = spark.createDataFrame(told, "image_id long, label_set_index int, t int, points_only boolean")
    images, labels, pixels = (f(spark, data) for f in (raster.images, raster.labels, raster.pixels))
    few = images.filter("image_id between 1 and 4")
    objects = measurements.object_rows(labels.filter("image_id < 0"), few, raster.SETS, [])
    rows = measurements.measured(spark, few, labels, pixels, objects, **measurements.RASTER, points=[4], told=told)["label_sets"].collect()
    assert {(r.image_id, r.label_set_index) for r in rows if r.locations_only} == {(1, 1), (1, 4), (3, 4), (4, 4)}


def test_sizes_are_made_once(spark, tmp_path):
    """Running sums read a group's size twice; what makes it is run once for each partition."""
    from pyspark.sql import functions as F

    log = tmp_path / "runs"

    def told(batches):
        with open(log, "a") as f:
            f.write("run\n")
        yield from batches

    rows = spark.createDataFrame([(g, k) for g in (1, 2, 5000) for k in range(g % 7)], "g long, k long")
    sizes = rows.groupBy("g").agg(F.count("*").alias("n")).coalesce(1).mapInArrow(told, "g long, n long")
    out = measurements.numbered(rows, ["g"], ["k"], "id", sizes).orderBy("g", "k").collect()
    assert [r.id for r in out] == list(range(1, 6)) and [r.g for r in out] == [1, 2, 2, 5000, 5000]
    assert log.read_text() == "run\n"


def test_overlaps_hold_no_voxel_in_a_hash_table(spark):
    """Labels of a voxel meet in order: no aggregation of a list for each voxel, which goes by sorted runs from the 129th on. As many
    pairs as by hand, with four sets at one voxel, and voxels that differ in one coordinate only."""
    from collections import Counter
    from itertools import combinations

    from maskframe.operators.relationships import PAIR, overlaps

    voxels = {(i, t, z, y, x): [(s, (y + s * x) % 3 + 1) for s in (4, 1, 3, 2) if (y * s + x + z) % 4 or s == 1] for i in (1, 2) for t in (0, 1) for z in (0, 1) for y in range(3) for x in range(4)}
    labels = spark.createDataFrame([(v[0], v[1], s, label, *v[2:]) for v, held in voxels.items() for s, label in held], "image_id long, t int, set_index int, label long, z long, y long, x long")
    found = overlaps(labels)
    by_hand = Counter((*v[:2], *a, *b) for v, held in voxels.items() for a, b in combinations(sorted(held), 2))
    assert {tuple(r[c] for c in PAIR): r.overlap_voxels for r in found.collect()} == by_hand
    assert "ObjectHashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
