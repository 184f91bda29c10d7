"""Settings, the steps together, exports, and surfaces."""

import json
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from maskframe.functions import models
from maskframe.operators import geometry, tiles
from maskframe.plans import measurements, workflow
from maskframe.plans.settings import EXPANSION, FIELDS, SKIP, Settings, command_line, configuration, configuration_errors, model_names, read_configuration, selected_channels, translated
from maskframe.sources import zarr

ROW = "image_id long, t int, z long, y long, x long, label long"


def test_settings():
    Settings().check(1)
    assert len(FIELDS) == 35 and Settings().values()["flow_threshold"] == 0.4
    for bad in ({"cell_model": SKIP}, {"cell_model": "x"}, {"cell_model": EXPANSION}, {"nucleus_model": "x"}, {"foci_model_1": "cellpose3:cyto"}, {"cell_nuclei_channel": -1}, {"cell_expansion_distance": -1}, {"measurements_database": "csv"}, {"foci_model_2": "spotiflow:general", "foci_channel_2": 3}, {"device": "tpu"}, {"foci_model_1": "spotiflow:synth_3d", "spotiflow_local_refinement": True}):
        with pytest.raises(ValueError):
            Settings.of(bad).check(2)
    Settings.of({"cell_model": EXPANSION + "cellpose3:nuclei", "measurements_database": SKIP, "remove_border_cells": "off", "unknown": 1}).check()
    with pytest.raises(TypeError):
        Settings(unknown=1)
    assert selected_channels(2, 1, 3) == [1, 0] and selected_channels(1, 1, 1) == [0]
    with pytest.raises(ValueError):
        selected_channels(4, 0, 3)
    assert Settings(cell_channel=1, cell_nuclei_channel=3).seed_channel == 3 and Settings(cell_channel=2, cell_nuclei_channel=1).seed_channel == 2


def test_older_settings():
    assert translated({"diameter": 3}) == {"diameter": 3}
    assert translated({"spotiflow_microsam_refinement": 1}) == {"spotiflow_local_refinement": 1}
    assert translated({"spotiflow_microsam_refinement": 1, "spotiflow_local_refinement": 0}) == {"spotiflow_local_refinement": 0}
    assert translated({"cell_step": "false", "nucleus_step": "yes", "foci_step_1": True, "foci_step_2": 0}) == {"cell_model": SKIP, "nucleus_model": "cellpose3:nuclei", "foci_model_1": "spotiflow:general", "foci_model_2": SKIP}
    assert translated({"cell_method": "cell-expansion"})["cell_model"] == EXPANSION + "cellpose3:nuclei"
    assert translated({"cell_step": True, "cell_nuclei_channel": 2}) == {"cell_nuclei_channel": 2, "nucleus_model": "cellpose3:nuclei", "nucleus_channel": 2}
    assert translated({"nucleus_step": True, "nucleus_model": "stardist:SD_Nuclei_Versatile", "cell_nuclei_channel": 0}) == {"nucleus_model": "stardist:SD_Nuclei_Versatile", "cell_nuclei_channel": 0}
    assert translated({"foci_step_3": "on", "foci_model_3": "spotiflow:hybiss", "cell_step": 0}) == {"cell_model": SKIP, "foci_model_3": "spotiflow:hybiss"}
    with pytest.raises(ValueError):
        translated({"cell_method": "x"})
    assert model_names('["a", " b "]') == model_names("a; b,") == model_names(["a", "b"]) == ["a", "b"] and model_names(None) == []


def test_configurations(tmp_path):
    document = configuration("run it")
    assert configuration_errors(document) == [] and len(document["parameters"]) == 35
    words = command_line(document, {"cell_channel": 3, "remove_border_cells": False, "nucleus_model": ""})
    assert words.startswith("run it --model cellpose3:nuclei") and "--cell-channel 3" in words and "--remove-border-cells False" in words and "--nucleus-model" not in words
    small = {"exec_function": {"cli_command": "x", "hidden_args": [{"name": "h", "value": "a b", "cli_tag": "--h", "cli_order": 1}]}, "inputs": [{"name": "i", "default": [1, 2], "cli_tag": "-i", "cli_order": 5}], "parameters": [{"name": "on", "type": "checkbox", "default": True, "cli_tag": "--on", "cli_order": 3}, {"name": "off", "type": "checkbox", "default": False, "cli_tag": "--off"}, {}]}
    assert command_line(small, {}) == "x --h 'a b' --on -i 1,2"
    wrong = configuration_errors(small)
    assert "citations is missing" in wrong and "parameters[2] has no name" in wrong and "parameters[2] has no cli_tag" in wrong
    (tmp_path / "c.json").write_text(json.dumps(document))
    assert read_configuration(str(tmp_path / "c.json")) == document
    (tmp_path / "c.json").write_text("[1]")
    with pytest.raises(ValueError):
        read_configuration(str(tmp_path / "c.json"))


def test_ids_run_over_timepoints_and_steps(spark):
    rows = lambda *r: spark.createDataFrame([(1, t, 0, y, x, k) for t, k, y, x in r], ROW)
    cells = rows((0, 5, 2, 2), (0, 5, 2, 3), (0, 9, 4, 4), (1, 3, 3, 3), (1, 4, 0, 0))
    nuclei = rows((0, 1, 2, 2), (0, 2, 4, 4), (1, 7, 3, 3))
    spots = rows((0, 2, 1, 1), (1, 1, 2, 1))
    out = {(r.t, r.set_index, r.y, r.x): r.label for r in workflow.multistep(cells, nuclei, [spots], 8, 8).collect()}
    assert out == {(0, 1, 2, 2): 1, (0, 1, 2, 3): 1, (0, 1, 4, 4): 2, (0, 2, 2, 2): 1, (0, 2, 4, 4): 2, (0, 3, 2, 3): 1, (0, 4, 1, 1): 4, (1, 1, 3, 3): 5, (1, 2, 3, 3): 5, (1, 4, 2, 1): 6}
    assert {r.label for r in workflow.multistep(cells, None, [], 8, 8).collect()} == {5, 9, 12}
    assert workflow.multistep(None, rows((0, 1, 0, 0)), [], 8, 8).count() == 1
    with pytest.raises(ValueError):
        workflow.multistep(None, None, [], 8, 8)


def test_case_status(spark):
    cases = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    got = workflow.case_status(cases, spark.createDataFrame([("a", None), ("b", "boom")], "key string, error string"))
    assert {r.key: r.status for r in got.collect()} == {"a": "success", "b": "failed", "c": "skipped"}


def test_exports(spark, data, tmp_path):
    tables = {k: v for k, v in measurements.tables(spark, data).items() if k in ("images", "label_sets", "schema_info")}
    for ending in ("duckdb", "sqlite"):
        workflow.export_database(tables, str(tmp_path / f"m.{ending}"), rows=7)
    assert duckdb.connect(str(tmp_path / "m.duckdb")).execute("SELECT count(*) FROM label_sets").fetchall() == [(tables["label_sets"].count(),)]
    assert not list(tmp_path.glob("*.partial"))
    with pytest.raises(ValueError):
        workflow.export_database(tables, str(tmp_path / "m.csv"))


def test_surfaces(spark):
    table = geometry.surface_table((1, 1, 1))
    assert table[0] == table[255] == 0 and math.isclose(table[1], math.sqrt(3) / 8) and math.isclose(table[15], 1)
    at = np.argwhere(np.linalg.norm(np.indices((21, 21, 21)) - 10, axis=0) <= 8)
    ball = spark.createDataFrame([(i, 0, 1, 1, *map(int, p)) for i in (1, 2) for p in at] + [(1, 0, 1, 2, 30, y, x) for y in range(3) for x in range(3)], "image_id long, t int, set_index int, label long, z long, y long, x long")
    scales = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, None, 1.0, 1.0)], "image_id long, sz double, sy double, sx double")
    rows = {(r.image_id, r.label): r for r in geometry.surfaces(ball, scales).collect()}
    assert rows.keys() == {(1, 1), (2, 1)} and rows[2, 1].surface_area_um2 is None
    r = rows[1, 1]
    sphericity = math.pi ** (1 / 3) * (6 * r.volume_um3) ** (2 / 3) / r.surface_area_um2
    assert r.volume_um3 == len(at) and abs(r.surface_area_um2 / (4 * math.pi * 64) - 1) < 0.12 and 0.85 < sphericity <= 1


def threshold(model):
    """A backend that labels what is bright: rows of bright pixels that touch, or single bright pixels for spots."""

    def make():
        def segment(plane):
            bright = plane > (180 if model.startswith("spotiflow") else 50)
            if model.startswith("spotiflow"):
                return np.where(bright, np.cumsum(bright).reshape(plane.shape), 0)
            out = np.zeros(plane.shape, int)
            for k, p in enumerate(np.argwhere(bright), 1):
                out[tuple(p)] = min([v for v in out[max(0, p[0] - 1) : p[0] + 1, max(0, p[1] - 1) : p[1] + 2].ravel() if v], default=k)
            return out

        return segment

    return make


def picture(fields, two=2):
    """For each field a signal with blocks and bright pixels, and a second channel with smaller blocks."""
    a = np.zeros((fields, two, 24, 24))
    for f in range(fields):
        for k, (y, x) in enumerate(((3, 3), (12, 8), (14, 17))[: 3 - f % 2]):
            a[f, 0, y : y + 6, x : x + 5] = 100 + k
            a[f, 0, y + 3, x + 2] = 200
            a[f, 1, y + 1 : y + 4, x + 1 : x + 4] = 90
    return a


def image_rows(spark, a):
    return spark.createDataFrame([(0, c, 0, y, x, float(v)) for (c, y, x), v in np.ndenumerate(a)], "t long, c long, z long, y long, x long, value double")


def test_a_run_from_store_to_tables(spark, tmp_path):
    source, out, tables = (f"file://{tmp_path}/{n}" for n in ("image.zarr", "out.zarr", "tables"))
    a = picture(1)[0]
    zarr.write_image(image_rows(spark, a), source, {"c": 2, "y": 24, "x": 24}, [("Signal", None), ("DNA", None)], {"y": 0.5, "x": 0.25}, "<u2", chunk=16)
    settings = Settings(cell_model="cellpose3:cyto3", nucleus_model="cellpose3:nuclei", nucleus_channel=2, foci_model_1="spotiflow:general")
    workflow.run(spark, source, out, settings, threshold, tables)
    measurements.opened(spark, tables)
    got = {r.object_type: r.n for r in spark.sql("SELECT object_type, count(*) n FROM object_features GROUP BY 1").collect()}
    assert got == {"cells": 3, "nuclei": 3, "cytoplasm": 3, "spots": 3}
    row = spark.sql("SELECT sum(voxel_count) v, sum(area_um2) a FROM objects WHERE object_type = 'cells'").first()
    assert row.v == 90 and math.isclose(row.a, 90 * 0.125)
    assert spark.sql("SELECT count(*) FROM foci_assignments WHERE target_object_type = 'cells' AND relation = 'inside'").first()[0] == 3
    assert spark.sql("SELECT intensity_max FROM intensity_features WHERE object_type = 'spots' AND channel_name = 'Signal'").first()[0] == 200
    stored = json.loads(spark.table("measurement_runs").first().settings_json)
    assert stored["nucleus_model"] == "cellpose3:nuclei" and len(stored) == 35
    assert json.loads((tmp_path / "out.zarr" / "labels" / ".zattrs").read_text())["labels"] == ["labels_cells", "labels_nuclei", "labels_cytoplasm", "labels_spots_channel_1"]
    assert zarr.read_image(spark, out)[1]["dtype"] == "uint16" and zarr.read_image(spark, out, "labels/labels_cells")[0].filter("value > 0").count() == 90
    workflow.run(spark, source, f"{out}.channels.zarr", Settings(cell_model="cellpose3:cyto3", nucleus_model="cellpose3:nuclei", nucleus_channel=2, include_original_channels=True), threshold)
    pixels, about = zarr.read_image(spark, f"{out}.channels.zarr")
    assert [n for n, _ in about["channels"]] == ["Signal", "DNA", "labels_cells", "labels_nuclei", "labels_cytoplasm"]
    assert {r.c: r.n for r in pixels.filter("value > 0").groupBy("c").agg(F.count("*").alias("n")).collect()} == {0: 90, 1: 27, 2: 90, 3: 27, 4: 63}
    with pytest.raises(ValueError):
        workflow.run(spark, source, out, Settings(nucleus_channel=3, nucleus_model="cellpose3:nuclei"), threshold)


def test_a_run_over_a_plate(spark, tmp_path):
    source, out, tables = (f"file://{tmp_path}/{n}" for n in ("plate.zarr", "out.zarr", "tables"))
    fields = ["A/1/0", "A/1/1", "B/2/0"]
    for a, path in zip(picture(3), fields, strict=True):
        zarr.write_image(image_rows(spark, a), f"{source}/{path}", {"c": 2, "y": 24, "x": 24}, [("Signal", None), ("DNA", None)], {"z": 2.0, "y": 0.5, "x": 0.25}, "<u2", chunk=16)
    (tmp_path / "plate.zarr" / ".zattrs").write_text(json.dumps({"plate": {"wells": [{"path": "A/1"}, {"path": "B/2"}]}}))
    for well, names in (("A/1", "01"), ("B/2", "0")):
        (tmp_path / "plate.zarr" / well / ".zattrs").write_text(json.dumps({"well": {"images": [{"path": n} for n in names]}}))
    whole, _ = zarr.read_plate(spark, source)
    assert whole.count() == 3 * 2 * 24 * 24
    # cells grow from nuclei, and spots are refined to masks
    settings = Settings(cell_model=EXPANSION + "cellpose3:nuclei", cell_channel=2, cell_expansion_distance=0.5, foci_model_1="spotiflow:general", spotiflow_local_refinement=True, remove_border_cells=False)
    workflow.run(spark, source, out, settings, threshold, tables)
    measurements.opened(spark, tables)
    wells = {(r.plate_row, r.plate_column, r.field_index): r.n for r in spark.sql("SELECT plate_row, plate_column, field_index, count(*) n FROM object_features WHERE object_type = 'cells' GROUP BY ALL").collect()}
    assert wells == {("A", "1", "0"): 3, ("A", "1", "1"): 2, ("B", "2", "0"): 3}
    assert spark.sql("SELECT min(voxel_count) FROM objects WHERE object_type = 'spots'").first()[0] > 1 and spark.sql("SELECT count(*) FROM objects WHERE is_point").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM (SELECT image_id, label_value FROM objects WHERE object_type <> 'spots' GROUP BY ALL HAVING count(DISTINCT object_type) < 3)").first()[0] == 0
    # refined spots have extents, so their sets hold more than places
    assert {r.label_name: r.locations_only for r in spark.sql("SELECT DISTINCT label_name, locations_only FROM label_sets").collect()}["labels_spots_channel_1"] is False
    assert [r.image_path for r in zarr.fields(spark, out).orderBy("image_path").collect()] == fields
    grown = zarr.read_image(spark, out, "A/1/1/labels/labels_cells")[0].filter("value > 0")
    assert grown.count() == spark.sql("SELECT sum(voxel_count) FROM object_features WHERE object_type = 'cells' AND plate_row = 'A' AND field_index = '1'").first()[0] > 18


def test_fields_of_several_forms_go_in_one_run(spark, tmp_path):
    """Sides, scales and channels of each field are its own, in the labels, in the tables, and in a plate with its own channels."""
    source, out, tables = (f"file://{tmp_path}/{n}" for n in ("plate.zarr", "out.zarr", "tables"))
    forms = {"A/1/0": (24, 0.5), "A/1/1": (40, 0.25), "B/2/0": (24, 0.5)}
    for a, (path, (n, scale)) in zip(picture(3), forms.items(), strict=True):
        zarr.write_image(image_rows(spark, np.pad(a, ((0, 0), (0, n - 24), (0, n - 24)))), f"{source}/{path}", {"c": 2, "y": n, "x": n}, [("Signal", None), ("DNA", None)], {"y": scale, "x": scale}, "<u2", chunk=16)
    (tmp_path / "plate.zarr" / ".zattrs").write_text(json.dumps({"plate": {"wells": [{"path": "A/1"}, {"path": "B/2"}]}}))
    for well, names in (("A/1", "01"), ("B/2", "0")):
        (tmp_path / "plate.zarr" / well / ".zattrs").write_text(json.dumps({"well": {"images": [{"path": n} for n in names]}}))
    settings = Settings(cell_model="cellpose3:cyto3", remove_border_cells=False, include_original_channels=True)
    workflow.run(spark, source, out, settings, threshold, tables)
    measurements.opened(spark, tables)
    shown = {r.source_resource_path: r for r in spark.sql("SELECT source_resource_path, size_y, size_c, source_dtype, scale_y_um FROM images").collect()}
    assert {p: (r.size_y, r.size_c, r.source_dtype, r.scale_y_um) for p, r in shown.items()} == {p: (n, 2, "uint16", s) for p, (n, s) in forms.items()}
    areas = {r.source_resource_path: r.a for r in spark.sql("SELECT source_resource_path, sum(area_um2) AS a FROM objects JOIN images USING (image_id) GROUP BY 1").collect()}
    assert {p: round(a, 6) for p, a in areas.items()} == {"A/1/0": 22.5, "A/1/1": 3.75, "B/2/0": 22.5}
    for path, (n, scale) in forms.items():
        pixels, about = zarr.read_image(spark, out, path)
        assert about["size"]["y"] == n and about["scales"]["y"] == scale and [c for c, _ in about["channels"]] == ["Signal", "DNA", "labels_cells", "labels_nuclei", "labels_cytoplasm"]
        counts = {r.c: r.n for r in pixels.filter("value > 0").groupBy("c").agg(F.count("*").alias("n")).collect()}
        assert counts[0] == counts[2] == 30 * (3 - (path == "A/1/1"))


def stars(log=None):
    """A backend that finds bright pixels, as labels or as polygons, and tells what it was given."""

    def make():
        class Stars:
            def __call__(self, values):
                if log:
                    with open(log, "a") as f:
                        f.write(f"{values.shape}\n")
                return np.where(values > 50, np.arange(1, values.size + 1).reshape(values.shape), 0)

            def polygons(self, values):
                return [(y, x, values[y, x], [1.5] * 32) for y, x in np.argwhere(values > 50)]

        return Stars()

    return make


def blocks_of(spark, a):
    rows = spark.createDataFrame([(1, 0, *map(int, p), float(v)) for p, v in np.ndenumerate(a)], "image_id long, t int, z long, y long, x long, value double")
    return tiles.to_blocks(rows, *a.shape[-2:], 16)


def test_models_see_tiles_volumes_and_their_own_pixel_size(spark, tmp_path):
    a = np.zeros((2, 50, 46))
    a[0, 10, 12] = a[0, 19, 20] = a[1, 30, 40] = 100
    blocks, log = blocks_of(spark, a), str(tmp_path / "log")
    backends = lambda model: stars(log)
    about = {"size": {"t": 1, "c": 1, "z": 2, "y": 50, "x": 46}, "scales": {"y": 0.25, "x": 0.25}}
    run = lambda about=about, **s: workflow.segmentation(Settings(cell_model=SKIP, **s), lambda c: blocks, about, backends)[0].collect()
    seen = lambda: {line.strip() for line in open(log)}
    # volumes at once, unless the settings keep to planes; then labels of two planes differ
    assert len({r.label for r in run(nucleus_model="cellpose3:nuclei")}) == 3 and seen() == {"(2, 50, 46)"}
    (tmp_path / "log").unlink()
    assert len({r.label for r in run(nucleus_model="cellpose3:nuclei", dimension_mode="2d")}) == 3 and seen() == {"(50, 46)"}
    (tmp_path / "log").unlink()
    # tiles of 1024 with a halo, as the model of foci has it
    wide = np.zeros((1, 1030, 40))
    wide[0, 5, 5] = wide[0, 1025, 7] = 100
    big = {"size": about["size"] | {"z": 1, "y": 1030, "x": 40}, "scales": {}}
    found = workflow.segmentation(Settings(cell_model=SKIP, foci_model_1="stardist:SD_Foci_Finn"), lambda c: blocks_of(spark, wide), big, backends)[0].collect()
    assert {(r.y, r.x) for r in found} == {(5, 5), (1025, 7)} and len({r.label for r in found}) == 2 and seen() == {"(1030, 40)", "(70, 40)"}
    # at half a micrometre, and back: by the nearest, or as polygons
    (tmp_path / "log").unlink()
    near = models.segmented_scaled(blocks_of(spark, 4 * a), "stardist:SD_Nuclei_Versatile", stars(log), 50, 46, 0.25, 0.25).collect()
    assert seen() == {"(25, 23)"} and {(r.z, r.y // 2, r.x // 2) for r in near} >= {(0, 5, 6), (0, 9, 10), (1, 15, 20)} and all(r.y < 50 and r.x < 46 for r in near)
    drawn = models.segmented_scaled(blocks_of(spark, 4 * a), "stardist:SD_Nuclei_Versatile", stars(log), 50, 46, 0.25, 0.25, smooth=True).collect()
    middle = {k: np.mean([(r.y, r.x) for r in drawn if r.z == 1], axis=0) for k in {r.label for r in drawn if r.z == 1}}
    assert middle and all(abs(m - np.array([30, 40])).max() < 3 for m in middle.values())
    with pytest.raises(Exception, match="gives no polygons"):
        models.segmented_scaled(blocks_of(spark, 4 * a), "m", lambda: lambda v: v > 50, 50, 46, 0.25, 0.25, smooth=True).collect()
    with pytest.raises(ValueError, match="scales"):
        run(about | {"scales": {}}, nucleus_model="stardist:SD_Nuclei_Versatile")
    same = {(r.z, r.y, r.x) for r in models.segmented_tiles(blocks, "m", stars(), 20, 4).collect()}
    assert same == {(0, 10, 12), (0, 19, 20), (1, 30, 40)}
