"""Blocks: the data source that reads and writes them, tiles with halos, and what is worked out over them."""

import json
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskframe.operators import polygons, spots, stencil, tiles
from maskframe.sources import chunks, zarr


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else json.dumps(content).encode())


def put_image(folder, a, size, axes="tczyx", order="C", mark=".", without=(), scale=None):
    """An uncompressed array under folder/0, and what the folder says of it."""
    put(folder / ".zattrs", {"multiscales": [{"axes": [*axes], "datasets": [{"path": "0", "coordinateTransformations": [{"type": "scale", "scale": scale or [1.0] * len(axes)}]}]}]})
    put(folder / "0" / ".zarray", {"shape": a.shape, "chunks": size, "dtype": a.dtype.str, "compressor": None, "fill_value": 7, "order": order, "filters": None, "dimension_separator": mark})
    for at in np.ndindex(*(-(-n // c) for n, c in zip(a.shape, size, strict=True))):
        if at not in without:
            block = np.zeros(size, a.dtype)
            part = a[tuple(slice(i * c, i * c + c) for i, c in zip(at, size, strict=True))]
            block[tuple(map(slice, part.shape))] = part
            put(folder / "0" / mark.join(map(str, at)), block.tobytes(order=order))


@pytest.fixture()
def image(tmp_path):
    rng = np.random.default_rng(40)
    a = rng.integers(0, 60_000, (4, 2, 3, 21, 30)).astype(">u2")
    put_image(tmp_path / "i.zarr", a, (2, 1, 2, 8, 16), without=[(1, 1, 1, 2, 1)])
    a = a.astype("<u2")
    a[2:, 1:, 2:, 16:, 16:] = 7
    return tmp_path / "i.zarr", a


def assembled(rows, shape):
    out = np.full(shape, -1.0)
    for r in rows:
        block = np.frombuffer(r.data, r.dtype).reshape(r.height, r.width)
        assert (out[r.t, r.c, r.z, r.y : r.y + r.height, r.x : r.x + r.width] == -1).all()
        out[r.t, r.c, r.z, r.y : r.y + r.height, r.x : r.x + r.width] = block
    return out


def test_blocks_are_the_image(spark, image):
    folder, a = image
    blocks = chunks.read_blocks(spark, f"file://{folder}")
    assert (assembled(blocks.collect(), a.shape) == a).all()
    ours = sorted(map(tuple, tiles.to_pixels(blocks).drop("image_path").collect()))
    assert ours == sorted(map(tuple, zarr.read_image(spark, f"file://{folder}")[0].collect()))
    for form, (axes, order, mark) in enumerate((("zyx", "F", "/"), ("yx", "C", "."), ("cyx", "C", "/"))):
        b = a[0, 0] if axes == "zyx" else a[0, 0, 0] if axes == "yx" else a[0, :, 0]
        put_image(folder.parent / f"o{form}.zarr", np.ascontiguousarray(b), [2] * (b.ndim - 2) + [8, 16], axes, order, mark)
        store = f"file://{folder.parent}/o{form}.zarr"
        assert sorted(map(tuple, tiles.to_pixels(chunks.read_blocks(spark, store)).drop("image_path").collect())) == sorted(map(tuple, zarr.read_image(spark, store)[0].collect()))


def opened(df):
    """How many chunks a plan's partitions may open."""
    return df.rdd.getNumPartitions()


def test_only_the_asked_chunks_are_read(spark, image):
    folder, a = image
    load = lambda **more: chunks.read_blocks(spark, f"file://{folder}", bytesPerPartition=1, **more)
    whole = load(pushdown="true")
    assert opened(load()) == opened(load(pushdown="true")) == 2 * 2 * 2 * 3 * 2
    asked = whole.filter("t = 3 and c = 1 and z < 2 and y >= 8 and x in (0, 5)")
    assert opened(asked) == 2 and "BatchScan" in asked._jdf.queryExecution().executedPlan().toString()
    got = asked.collect()
    assert sorted((r.t, r.c, r.z, r.y, r.x) for r in got) == [(3, 1, z, y, 0) for z in (0, 1) for y in (8, 16)]
    assert all((np.frombuffer(r.data, r.dtype).reshape(r.height, r.width) == a[r.t, r.c, r.z, r.y : r.y + r.height, r.x : r.x + r.width]).all() for r in got)
    # what isn't asked for may be broken or gone
    for f in (folder / "0").iterdir():
        if not f.name.startswith((".", "1.1.0.1.0", "1.1.0.2.0")):
            f.write_bytes(b"broken")
    assert len(asked.collect()) == 4
    assert load(pushdown="true").filter("t > 17").count() == 0 and load(pushdown="true").filter("c = 0 and image_path = 'other'").count() == 0
    # the same by options; frames of one load may be filtered in several ways
    named = load(t=[3], c=[1], z=":2", y="8:", x=[0, 5])
    assert opened(named) == 2 and sorted(map(tuple, named.drop("data").collect())) == sorted(map(tuple, asked.drop("data").collect()))
    assert load(t=[17]).count() == 0 and load(images=[]).count() == 0
    assert sorted((r.z, r.y) for r in named.filter("z = 0").unionByName(named.filter("y = 8")).collect()) == [(0, 8), (0, 8), (0, 16), (1, 8)]
    # several chunks to a partition, and conditions that aren't pushed down
    assert opened(chunks.read_blocks(spark, f"file://{folder}", bytesPerPartition=4 * 2 * 2 * 8 * 16 * 2)) < 24
    assert chunks.read_blocks(spark, f"file://{folder}", pushdown="true").filter("t = 3 and c = 1 and z < 2 and y >= 8 and x = 0 and (y + z) % 2 = 1").count() == 2


def test_fields_of_a_plate_have_their_own_forms(spark, tmp_path):
    rng = np.random.default_rng(41)
    shapes = {"A/1/0": (1, 9, 9), "A/1/1": (2, 12, 7), "B/2/0": (1, 5, 20)}
    put(tmp_path / "p.zarr" / ".zattrs", {"plate": {"wells": [{"path": "B/2"}, {"path": "/A/1/"}, {}]}})
    for well, names in (("A/1", "01"), ("B/2", "0")):
        put(tmp_path / "p.zarr" / well / ".zattrs", {"well": {"images": [{"path": n} for n in names]}})
    arrays = {p: rng.integers(0, 200, s).astype("u1" if p < "B" else "<i4") for p, s in shapes.items()}
    for k, (p, a) in enumerate(arrays.items()):
        put_image(tmp_path / "p.zarr" / p, a, (1, 4, 4), "cyx", scale=[1, 0.5 + k, 0.25])
    blocks = chunks.read_blocks(spark, f"file://{tmp_path}/p.zarr").filter("c = 0")
    got = {(r.image_path, r.y, r.x): r.value for r in tiles.to_pixels(blocks).collect()}
    assert got == {(p, y, x): v for p, a in arrays.items() for (y, x), v in np.ndenumerate(a[0])}
    forms = {r.image_path: r for r in chunks.forms(spark, f"file://{tmp_path}/p.zarr", zarr.fields(spark, f"file://{tmp_path}/p.zarr")).collect()}
    assert [(forms[p].size_c, forms[p].size_y, forms[p].size_x, forms[p].scale_y, forms[p].dtype, forms[p].scale_z) for p in shapes] == [(1, 9, 9, 0.5, "uint8", None), (2, 12, 7, 1.5, "uint8", None), (1, 5, 20, 2.5, "int32", None)]


def test_large_numbers_are_exact_or_an_error(spark, tmp_path):
    a = np.array([[2**60 + 1, 5], [6, 7]], "<i8")
    put_image(tmp_path / "i.zarr", a, (2, 2), "yx")
    blocks = chunks.read_blocks(spark, f"file://{tmp_path}/i.zarr")
    assert sorted(r.value for r in tiles.to_pixels(blocks, kind="long").collect()) == [5, 6, 7, 2**60 + 1]
    for rows in (tiles.to_pixels(blocks), zarr.read_image(spark, f"file://{tmp_path}/i.zarr")[0]):
        with pytest.raises(Exception, match="isn't exact"):
            rows.collect()


def block_rows(spark, a, tile, keys=("t", "c", "z")):
    pixels = spark.createDataFrame([(*map(int, p), float(v)) for p, v in np.ndenumerate(a)], ", ".join(f"{n} long" for n in (*keys, "y", "x")) + ", value double")
    return tiles.to_blocks(pixels, *a.shape[-2:], tile, dtype="<u2")


def written(spark):
    """Bytes that shuffles have written in this session."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_halos_cost_little_more_than_the_pixels(spark, image):
    rng = np.random.default_rng(42)
    a = rng.integers(0, 65_536, (1, 1, 2, 700, 900)).astype("<u2")
    put_image(image[0].parent / "large.zarr", a, (1, 1, 1, 256, 256))
    blocks = chunks.read_blocks(spark, f"file://{image[0].parent}/large.zarr")
    before = written(spark)
    out = tiles.smoothed(blocks, 256).collect()
    assert a.nbytes < written(spark) - before < 1.2 * a.nbytes
    padded = np.pad(a[0, 0].astype(float), ((0, 0), (1, 1), (1, 1)), mode="edge")
    want = sum(w * v * padded[:, i : i + 700, j : j + 900] for i, w in enumerate((1, 2, 1)) for j, v in enumerate((1, 2, 1))) / 16
    assert (assembled(out, a.shape)[0, 0] == want).all()


def test_tiles_of_any_size_hold_their_halo(spark):
    rng = np.random.default_rng(43)
    a = rng.integers(1, 900, (1, 1, 2, 23, 31))
    for tile, halo in ((7, 0), (7, 3), (5, 9), (64, 4), (None, 0)):
        rows = tiles.retiled(block_rows(spark, a, 10), tile, halo).collect()
        for r in rows:
            side = tile or 31
            y0, x0, y1, x1 = max(0, r.core_y - halo), max(0, r.core_x - halo), min(23, r.core_y + r.core_height + halo), min(31, r.core_x + r.core_width + halo)
            assert (r.core_height, r.core_width) == (min(side, 23 - r.core_y), min(side, 31 - r.core_x))
            assert (np.frombuffer(r.data, r.dtype).reshape(r.height, r.width) == a[0, 0, r.z, y0:y1, x0:x1]).all() and (r.y, r.x) == (y0, x0)
        assert sum(r.core_height * r.core_width for r in rows) == a.size
        back = assembled(tiles.trimmed(tiles.retiled(block_rows(spark, a, 10), tile, halo)).collect(), a.shape)
        assert (back == a).all()


def test_smoothing_over_many_tiles_fills_what_is_not_finite(spark):
    rng = np.random.default_rng(44)
    a = rng.integers(0, 50, (2, 14, 17)).astype(float)
    a[1, 3, 4], a[1, 13, 16] = np.nan, np.inf
    pixels = spark.createDataFrame([(1, *map(int, p), float(v)) for p, v in np.ndenumerate(a)], "image_id long, z long, y long, x long, value double")
    got = {(r.z, r.y, r.x): r.value for r in stencil.binomial_smooth(pixels, 14, 17, tile=6).collect()}
    clean = np.where(np.isfinite(a), a, np.median(a[1][np.isfinite(a[1])]))
    assert all(np.isclose(got[z, y, x], tiles.binomial(clean[z])[y, x]) for z, y, x in np.ndindex(a.shape)) and len(got) == a.size


def test_writes_appear_whole_or_not_at_all(spark, tmp_path):
    rng = np.random.default_rng(45)
    a = rng.integers(1, 900, (1, 2, 1, 20, 17))
    rows = spark.createDataFrame([(*map(int, p), float(v)) for p, v in np.ndenumerate(a)], "t long, c long, z long, y long, x long, value double")
    out = f"file://{tmp_path}/out.zarr"
    size = dict(zip(zarr.AXES, a.shape, strict=True))
    zarr.write_image(rows, out, size, [("a", None), ("b", None)], dtype="<u2", chunk=8)
    whole = lambda: assembled(chunks.read_blocks(spark, out).collect(), a.shape)
    assert (whole() == a).all()
    # a task that fails leaves what stood there
    bad = rows.withColumn("value", F.when((F.col("y") == 19) & (F.col("c") == 1), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value") + 1))
    with pytest.raises(Exception, match="lost"):
        zarr.write_image(bad, out, size, [("a", None), ("b", None)], dtype="<u2", chunk=8)
    assert (whole() == a).all() and not list(tmp_path.glob("*.partial")) and not list(tmp_path.glob("*.replaced"))
    # blocks that are no chunks, and a number of chunks that isn't the expected one
    (tmp_path / "out.zarr.partial" / "image" / "0").mkdir(parents=True)
    blocks = block_rows(spark, a, 8).withColumn("path", F.lit("image/0"))
    with pytest.raises(Exception, match="no chunk"):
        zarr.put_blocks(blocks, out, 10, "image")
    assert not (tmp_path / "out.zarr.partial").exists()
    (tmp_path / "out.zarr.partial" / "image" / "0").mkdir(parents=True)
    with pytest.raises(Exception, match="19 chunks|chunks of 19"):
        zarr.put_blocks(blocks, out, 8, "image", expected=19)
    assert (whole() == a).all()


def test_a_second_copy_of_a_task_changes_nothing(spark, tmp_path):
    a = np.random.default_rng(46).integers(1, 900, (1, 1, 1, 20, 17))
    blocks = block_rows(spark, a, 8).withColumn("path", F.lit("0"))
    batches = blocks.toArrow().to_batches()
    (tmp_path / "out.zarr.partial" / "0").mkdir(parents=True)
    put(tmp_path / "out.zarr.partial" / "marker", b"1")
    writer = chunks.BlocksWriter({"path": f"file://{tmp_path}/out.zarr", "chunk": "8", "expected": "9"})
    first, second = writer.write(iter(batches)), writer.write(iter(batches))
    assert first == second == chunks.Written(9)
    writer.commit([first, None])
    stored = {f.name: f.read_bytes() for f in (tmp_path / "out.zarr" / "0").iterdir()}
    assert len(stored) == 9 and (tmp_path / "out.zarr" / "marker").exists()
    # one that runs after the commit finds no place to write to
    with pytest.raises(OSError):
        writer.write(iter(batches))
    assert stored == {f.name: f.read_bytes() for f in (tmp_path / "out.zarr" / "0").iterdir()} and not (tmp_path / "out.zarr.partial").exists()
    shutil.rmtree(tmp_path / "out.zarr")


def plain_components(mask):
    """Labels by the first place of each 8-connected component, flood by flood."""
    out, width = np.zeros(mask.shape, int), mask.shape[1]
    for y, x in np.argwhere(mask):
        if not out[y, x]:
            open_ends = [(y, x)]
            out[y, x] = y * width + x + 1
            while open_ends:
                a, b = open_ends.pop()
                for p in ((a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                    if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < width and mask[p] and not out[p]:
                        out[p] = y * width + x + 1
                        open_ends.append(p)
    return out


def spiral(n):
    """One component that winds through every tile many times."""
    out = np.zeros((n, n), bool)
    for k in range(0, n // 2, 2):
        out[k, k : n - k] = out[n - 1 - k, k : n - k] = out[k : n - k, k] = out[k : n - k, n - 1 - k] = True
        if k + 2 < n // 2:
            out[k + 1, k] = k == 0 or out[k + 1, k]
            out[k + 1, k + 1] = True
    return out


def test_components_of_one_mask():
    rng = np.random.default_rng(47)
    for mask in [rng.random(rng.integers(1, 30, 2)) < d for d in (0.1, 0.4, 0.6, 0.95) for _ in range(10)] + [spiral(40), np.zeros((5, 5), bool), np.ones((4, 7), bool)]:
        assert (spots.label_mask(mask) == plain_components(mask)).all()


def test_components_across_tiles(spark):
    rng = np.random.default_rng(48)
    planes = {0: rng.random((60, 75)) < 0.38, 1: np.pad(spiral(60), ((0, 0), (0, 15))), 2: np.zeros((60, 75), bool), 3: rng.random((60, 75)) < 0.6}
    rows = spark.createDataFrame([(7, t, int(y), int(x)) for t, m in planes.items() for y, x in np.argwhere(m)], "image_id long, t int, y long, x long")
    for tile in (13, 32, 100):
        got = {(r.t, r.y, r.x): r.label for r in spots.components(rows, 60, 75, tile).collect()}
        assert got == {(t, int(y), int(x)): int(want[y, x]) for t, m in planes.items() for want in [plain_components(m)] for y, x in np.argwhere(m)}


def test_components_of_a_large_plane(spark, tmp_path):
    """4096 by 4096 in tiles of 1024: blobs that go over edges and corners."""
    rng = np.random.default_rng(49)
    a = np.zeros((4096, 4096), "u1")
    for y, x in rng.integers(0, 4090, (1500, 2)):
        a[y : y + rng.integers(1, 40), x : x + rng.integers(1, 40)] = 1
    a[1000:1050, :] = a[:, 2040:2050] = 1
    put_image(tmp_path / "i.zarr", a, (1024, 1024), "yx")
    found = spots.components_of_blocks(chunks.read_blocks(spark, f"file://{tmp_path}/i.zarr"), 1024)
    want = spots.label_mask(a != 0)
    sizes = dict(zip(*np.unique(want[want > 0], return_counts=True), strict=True))
    assert {r.label: r.n for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()} == sizes and len(sizes) > 500


def test_candidates_settle_in_groups_that_meet(spark, monkeypatch):
    """As one contest of a whole plane, and no group is larger than what meets."""
    rng = np.random.default_rng(50)
    rows = []
    for z in range(3):
        for point in range(60):
            sy, sx = (int(v) for v in rng.integers(0, 40, 2))
            mask = [[0, 0], *({(int(dy), int(dx)) for dy, dx in rng.integers(-2, 3, (rng.integers(0, 9), 2))} - {(0, 0)})]
            rows.append((1, 0, z, point, sy, sx, float(rng.integers(0, 9)), len(mask) == 1, [list(m) for m in mask]))
    found = spark.createDataFrame(rows, "image_id long, t int, z long, point long, sy long, sx long, score double, fallback boolean, mask array<array<int>>")
    got = {(r.z, r.point): (r.label, r.removed, sorted(map(tuple, r.places))) for r in spots.settled(found).collect()}
    groups = {(r.z, r.id): r.root for r in spots.conflicts(found).collect()}
    for z in range(3):
        plane, taken, last = sorted((r for r in rows if r[2] == z), key=lambda r: (-r[6], r[3])), set(), 0
        places = {r[3]: {(r[4] + dy, r[5] + dx) for dy, dx in r[8]} for r in plane}
        for r in plane:
            free = places[r[3]] - taken
            if (r[4], r[5]) in taken or not free:
                assert got[z, r[3]] == (None, 0, [])
                continue
            last += 1
            taken |= free
            assert got[z, r[3]] == (last, len(places[r[3]]) - len(free), sorted(free))
        meets = lambda a: [b for b in places if b != a and places[a] & places[b]]  # noqa: B023, E731
        for p in places:
            assert ((z, p) in groups) == bool(meets(p)) and all(groups[z, p] == groups[z, b] for b in meets(p))
            if (z, p) in groups:
                reach, ends = {p}, [p]
                while ends:
                    ends += [b for b in meets(ends.pop()) if b not in reach and not reach.add(b)]
                assert groups[z, p] == min(reach)


def test_bilinear_weights():
    for n, m in ((7, 7), (8, 4), (5, 11), (32, 20), (100, 1), (1, 9)):
        w = stencil.bilinear_matrix(n, m)
        assert w.shape == (m, n) and np.allclose(w.sum(axis=1), 1) and (w >= 0).all()
        # a straight line stays one where the triangle isn't cut
        line, place = w @ np.arange(n), n / m * (np.arange(m) + 0.5)
        inside = (place >= 1) & (place <= n - 1)
        assert m < n or np.allclose(line[inside], place[inside] - 0.5)
    assert np.allclose(stencil.bilinear_matrix(4, 2), [[3 / 7, 3 / 7, 1 / 7, 0], [0, 1 / 7, 3 / 7, 3 / 7]]) and np.allclose(stencil.bilinear_matrix(2, 4), [[1, 0], [0.75, 0.25], [0.25, 0.75], [0, 1]])


def test_bilinear_rows_and_blocks_agree(spark):
    a = np.random.default_rng(51).integers(0, 99, (2, 11, 17)).astype(float)
    pixels = spark.createDataFrame([(1, *map(int, p), float(v)) for p, v in np.ndenumerate(a)], "image_id long, z long, y long, x long, value double")
    for h, w in ((11, 6), (25, 17), (5, 40)):
        want = {(z, y, x): v for z in (0, 1) for (y, x), v in np.ndenumerate(stencil.bilinear_matrix(11, h) @ a[z] @ stencil.bilinear_matrix(17, w).T)}
        rows = {(r.z, r.y, r.x): r.value for r in stencil.resized_bilinear(pixels, 11, 17, h, w).collect()}
        blocks = {(r.z, r.y, r.x): r.value for r in tiles.to_pixels(stencil.resized_planes(tiles.to_blocks(pixels, 11, 17, 8), h, w, "<f8")).collect()}
        assert rows.keys() == blocks.keys() == want.keys() and all(np.isclose(rows[k], v) and np.isclose(blocks[k], v) for k, v in want.items())


def test_polygons_by_even_and_odd_crossings(spark):
    rng = np.random.default_rng(52)
    shapes = [(0, k, float(rng.uniform(-3, 33)), float(rng.uniform(-3, 43)), float(rng.integers(0, 4)), [float(d) for d in (rng.uniform(3, 3.4, 16) if k % 2 else rng.choice([1.3, 6.7], 12) + rng.random(12))]) for k in range(25)]
    shapes += [(1, 1, 5.0, 5.0, 0.5, [2.0, 2.0, 2.0, 2.0]), (1, 2, 9.5, 4.25, 0.5, [3.0, 3.0]), (1, 3, 90.0, 90.0, 1.0, [3.0] * 8)]
    frame = spark.createDataFrame(shapes, "z long, point long, py double, px double, prob double, dist array<double>")
    for sy, sx in ((1.0, 1.0), (1.5, 0.75)):
        got = {(r.z, r.y, r.x): r.label for r in polygons.polygons_to_labels(frame, 40, 50, sy, sx).collect()}
        want = {}
        for z, point, py, px, prob, dist in sorted(shapes, key=lambda s: (s[4], s[1])):
            turn = np.arange(len(dist)) * 2 * np.pi / len(dist)
            cy, cx = py * sy + np.array(dist) * sy * np.sin(turn), px * sx + np.array(dist) * sx * np.cos(turn)
            for y in range(40):
                for x in range(50):
                    crossed = [cx[i] + (y - cy[i]) * (cx[j] - cx[i]) / (cy[j] - cy[i]) for i in range(len(dist)) for j in [(i + 1) % len(dist)] if (cy[i] <= y) != (cy[j] <= y)]
                    if len(dist) > 2 and (sum(c < x for c in crossed) % 2 or any(c == x for c in crossed)):
                        want[z, y, x] = point
        assert got == want and len({v for v in want.values()}) > 10
    cut = spark.createDataFrame([(0, 0, 3.0, 9.9), (0, 0, 3.0, 10.0), (0, 1, 3.0, 10.0), (1, 0, 9.0, 4.0)], "tile_y long, tile_x long, py double, px double")
    assert sorted((r.tile_x, r.px) for r in polygons.in_cores(cut, 10).collect()) == [(0, 9.9), (1, 10.0)]
