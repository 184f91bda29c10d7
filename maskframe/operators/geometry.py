"""Shape features that need geometry: hulls, holes, largest diameters and surfaces.

An object's voxels combine to words of 64 pixels of a row before they are shuffled, and its words to one row; numpy then measures
many flat objects at once, so neither an image nor a label set stands in one task and no object costs a Python call of its own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.raster import OBJECT


#: No point: larger than any place.
FAR = np.int64(1) << 40
#: Forms that a task keeps the measures of.
FORMS = 1024
#: Rows up to which an object's points are compared all with all.
LOW = 16


def envelope(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower convex hulls of many objects at once: at[i, v] is the least place of object i in row v, FAR where it has none. Of each
    object the rows and places of its corners, and how many it has; all objects take one row after another."""
    n, height = at.shape
    rows, places, count, every = np.zeros((n, height), np.int64), np.zeros((n, height), np.int64), np.zeros(n, np.int64), np.arange(n)
    for v in range(height):
        there = at[:, v] < FAR
        open_ends = every[there & (count > 1)]
        while len(open_ends):
            k = count[open_ends]
            y1, x1, y2, x2 = rows[open_ends, k - 2], places[open_ends, k - 2], rows[open_ends, k - 1], places[open_ends, k - 1]
            # the last corner goes if it isn't below the line from the one before it to the new point
            open_ends = open_ends[(x2 - x1) * (v - y1) >= (at[open_ends, v] - x1) * (y2 - y1)]
            count[open_ends] -= 1
            open_ends = open_ends[count[open_ends] > 1]
        new = every[there]
        rows[new, count[new]], places[new, count[new]] = v, at[new, v]
        count[new] += 1
    return rows, places, count


def first_inside(rows: np.ndarray, places: np.ndarray, count: np.ndarray, height: int) -> np.ndarray:
    """Of each object and odd half row 2 y + 1 the least pixel whose centre the hull holds, in whole numbers."""
    out = np.full((len(rows), height), FAR)
    every = np.arange(len(rows))
    live = np.arange(rows.shape[1]) < count[:, None]
    for y in range(height):
        v = 2 * y + 1
        k = (live & (rows <= v)).sum(axis=1) - 1
        inside = every[(k >= 0) & (rows[every, count - 1] >= v)]
        k = np.minimum(k[inside], count[inside] - 2)
        y1, x1, y2, x2 = rows[inside, k], places[inside, k], rows[inside, k + 1], places[inside, k + 1]
        # ceiling of the line's place, halved as places are in half pixels
        out[inside, y] = -((-((y2 - v) * x1 + (v - y1) * x2)) // (2 * (y2 - y1)))
    return out


def extents(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least places by half row of the extents (the middles of pixels' sides) of rows that go from first to last; FAR for none."""
    n, height = first.shape
    out = np.full((n, 2 * height + 1), FAR)
    out[:, 1::2] = np.where(first < FAR, 2 * first - 1, FAR)
    side = np.where(first < FAR, 2 * first, FAR)
    out[:, :-1:2] = np.minimum(out[:, :-1:2], side)
    out[:, 2::2] = np.minimum(out[:, 2::2], side)
    return out


def farthest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The largest distance between two points of each object's extents, in pixels."""
    if left.shape[1] > 2 * LOW + 1:
        out = np.zeros(len(left))
        hulls = [envelope(left), envelope(-np.where(right < FAR, right, -FAR))]
        for i in range(len(left)):
            points = np.concatenate([np.stack([rows[i, : count[i]], sign * places[i, : count[i]]], axis=1) for (rows, places, count), sign in zip(hulls, (1, -1), strict=True)]).astype(float)
            out[i] = max(((points - p) ** 2).sum(axis=1).max() for p in points)
        return np.sqrt(out) / 2
    out = np.zeros(len(left))
    for a in range(left.shape[1]):
        for b in range(left.shape[1]):
            both = (left[:, a] < FAR) & (right[:, b] < FAR)
            for x, z in ((right[:, b], left[:, a]), (left[:, b], left[:, a]), (right[:, b], right[:, a])):
                out = np.where(both, np.maximum(out, (a - b) ** 2 + (x - z).astype(float) ** 2), out)
    return np.sqrt(out) / 2


def convex_and_feret(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For objects of like height, by their rows' first and last pixels (FAR for an empty row): the pixels whose centres lie in the hull
    of the pixels' extents, and the largest distance between two points of the outline of those."""
    height = first.shape[1]
    mirrored = np.where(last < FAR, -last, FAR)
    low = first_inside(*envelope(extents(first, last)), height)
    high = first_inside(*envelope(extents(mirrored, mirrored)), height)
    full = (low < FAR) & (high < FAR) & (low <= -high)
    size = np.where(full, -high - low + 1, 0).sum(axis=1)
    low, high = np.where(full, low, FAR), np.where(full, high, FAR)
    right = extents(high, high)
    return size, farthest(extents(low, low), np.where(right < FAR, -right, FAR))


def hull_planes(points: np.ndarray, slack: float = 1e-9) -> np.ndarray | None:
    """The planes (normal, offset) of the convex hull of points in space, normal @ p <= offset inside; None if it is flat.

    The point farthest outside is added again and again: the faces that it sees give way to faces from it to their outline."""
    a, b = points[points[:, 0].argmin()], points[points[:, 0].argmax()]
    line = np.linalg.norm(np.cross(points - a, b - a), axis=1)
    c = points[line.argmax()]
    normal = np.cross(b - a, c - a)
    height = (points - a) @ normal
    d = points[np.abs(height).argmax()]
    if line.max() <= slack or np.abs(height).max() <= slack:
        return None
    middle = (a + b + c + d) / 4

    def face(p, q, r):
        n = np.cross(q - p, r - p)
        n = n / np.linalg.norm(n)
        return (p, q, r, n, n @ p) if n @ (middle - p) < 0 else (p, r, q, -n, -n @ p)

    faces = [face(a, b, c), face(a, b, d), face(a, c, d), face(b, c, d)]
    while True:
        planes = np.array([[*f[3], f[4]] for f in faces])
        above = points @ planes[:, :3].T - planes[:, 3]
        p, seen = points[above.max(axis=1).argmax()], above[above.max(axis=1).argmax()] > slack
        if not seen.any():
            return planes
        sides: dict[tuple, tuple] = {}
        for f in (f for f, s in zip(faces, seen, strict=True) if s):
            for q, r in ((f[0], f[1]), (f[1], f[2]), (f[2], f[0])):
                if sides.pop((tuple(r), tuple(q)), None) is None:
                    sides[tuple(q), tuple(r)] = (q, r)
        faces = [f for f, s in zip(faces, seen, strict=True) if not s]
        faces += [face(q, r, p) for q, r in sides.values() if np.linalg.norm(np.cross(r - q, p - q)) > slack]


def convex_volume(mask: np.ndarray) -> int:
    """Voxels whose centres lie in the hull of the voxels' extents."""
    at = np.argwhere(mask)
    # of each row along the last axis only the ends can be corners
    order = np.lexsort(at.T[::-1])
    rows = at[order]
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    ends = np.concatenate([rows[new], rows[np.concatenate([new[1:], [True]])]]).astype(float)
    points = np.unique(np.concatenate([ends + d for d in 0.5 * np.concatenate([np.eye(3), -np.eye(3)])]), axis=0)
    planes = hull_planes(points)
    grid = np.indices(mask.shape).reshape(3, -1)
    inside = np.ones(grid.shape[1], bool)
    for *n, offset in planes:
        inside &= np.array(n) @ grid <= offset + 1e-7
    return int(inside.sum())


def filled(mask: np.ndarray) -> np.ndarray:
    """The mask with its holes: background that full connectivity doesn't join to the outside. Any number of axes."""
    free = ~np.pad(mask, 1)
    out = np.zeros_like(free)
    out[(0,) * mask.ndim] = True
    while True:
        grown = out
        for axis in range(mask.ndim):
            wide = grown.copy()
            lo, hi = [slice(None)] * mask.ndim, [slice(None)] * mask.ndim
            lo[axis], hi[axis] = slice(0, -1), slice(1, None)
            wide[tuple(hi)] |= grown[tuple(lo)]
            wide[tuple(lo)] |= grown[tuple(hi)]
            grown = wide
        grown = grown & free
        if (grown == out).all():
            return ~out[(slice(1, -1),) * mask.ndim]
        out = grown


def euler_3d(mask: np.ndarray) -> int:
    """Euler number of a volume with full connectivity: vertices, edges, faces and cubes of the union of closed voxels."""
    padded = np.pad(mask, 1)
    total = 0
    for dims in range(8):
        # a cell is open along the axes in dims; it belongs to the union if any voxel around it does
        cell = padded
        for axis in range(3):
            if not dims >> axis & 1:
                lo, hi = [slice(None)] * 3, [slice(None)] * 3
                lo[axis], hi[axis] = slice(0, -1), slice(1, None)
                cell = cell[tuple(lo)] | cell[tuple(hi)]
        total += (-1) ** bin(dims).count("1") * int(cell.sum())
    return total


WORDS = "array<struct<z:bigint,y:bigint,w:bigint,bits:bigint>>"
SHAPES = "image_id long, t int, set_index int, label long, convex_size double, filled_size double, feret_diameter_max_px double, euler_number_3d int"


def words(labels: DataFrame) -> DataFrame:
    """A row for each object: its voxels as bits, 64 places of a row to a word."""
    by_word = labels.groupBy(*OBJECT, "z", "y", F.floor(F.col("x") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(x % 64 as int))")).alias("bits"))
    return by_word.groupBy(*OBJECT).agg(F.collect_list(F.struct("z", "y", "w", "bits")).alias("words"))


def mask_of(rows: list[dict]) -> np.ndarray:
    """An object's voxels in its box, from its words."""
    z, y, w, bits = (np.array([r[k] for r in rows], np.int64) for k in ("z", "y", "w", "bits"))
    on = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    k, x = np.nonzero(on)
    at = np.stack([z[k], y[k], 64 * w[k] + x], axis=1)
    at -= at.min(axis=0)
    mask = np.zeros(at.max(axis=0) + 1, bool)
    mask[tuple(at.T)] = True
    return mask


def runs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of a batch of objects as words: for each row of an object the object, z, y, first and last pixel, and number of pixels."""
    parts = batch.column(4)
    flat, ends = parts.values, np.asarray(parts.offsets)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    z, y, w, bits = (flat.field(k).to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] for k in ("z", "y", "w", "bits"))
    on = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    first, last, n = 64 * w + on.argmax(axis=1), 64 * w + 63 - on[:, ::-1].argmax(axis=1), on.sum(axis=1, dtype=np.int64)
    order = np.lexsort((y, z, owner))
    owner, z, y, first, last, n = (v[order] for v in (owner, z, y, first, last, n))
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (z[1:] != z[:-1]) | (y[1:] != y[:-1])]))
    return owner[new], z[new], y[new], np.minimum.reduceat(first, new), np.maximum.reduceat(last, new), np.add.reduceat(n, new)


def shapes(labels: DataFrame) -> DataFrame:
    """Of each object the size of its hull and of itself without holes; the largest diameter if it is flat, else the Euler number.

    Flat objects of like height are measured together, by their rows' ends; only those with a gap in a row are looked at one by one
    for holes, as are volumes, and of these equal forms once."""

    def work(batches):
        known: dict[tuple, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            m = batch.num_rows
            convex, full, wide, euler = np.zeros(m), np.zeros(m), np.full(m, np.nan), np.zeros(m, np.int32)
            owner, z, y, first, last, n = runs_of(batch)
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            deep = np.maximum.reduceat(z, start) > np.minimum.reduceat(z, start)
            top, rows = np.minimum.reduceat(y, start), np.maximum.reduceat(y, start) - np.minimum.reduceat(y, start) + 1
            gaps = np.logical_or.reduceat(last - first + 1 > n, start)
            full[:] = np.add.reduceat(n, start)
            size = np.maximum(1, 2 ** np.ceil(np.log2(rows)).astype(int))
            for height in np.unique(size[~deep]).tolist():
                for some in np.array_split(chosen := np.flatnonzero(~deep & (size == height)), -(-len(chosen) * height // (1 << 18))):
                    place = np.full(m, -1)
                    place[some] = np.arange(len(some))
                    of = place[owner] >= 0
                    ends = np.full((2, len(some), height), FAR)
                    ends[:, place[owner[of]], (y - top[owner])[of]] = first[of], last[of]
                    convex[some], wide[some] = convex_and_feret(*ends)
            for i in np.flatnonzero(deep | gaps).tolist():
                mask = mask_of(batch.column(4)[i].as_py())
                form = mask.shape, np.packbits(mask).tobytes()
                if form not in known:
                    if len(known) >= FORMS:
                        known.clear()
                    known[form] = (filled(mask).sum(), convex_volume(mask), euler_3d(mask)) if deep[i] else (filled(mask[0]).sum(), 0, 0)
                full[i], hull, number = known[form]
                if deep[i]:
                    convex[i], euler[i] = hull, number
            out = [pa.array(convex), pa.array(full), pa.array(wide, mask=deep), pa.array(euler, mask=~deep)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *out], names=[c.split(" ")[0] for c in SHAPES.split(", ")])

    return words(labels).mapInArrow(work, SHAPES)


def _loops(inside: tuple[bool, ...]) -> list[list[tuple[int, int]]]:
    """The closed outlines, as cube edges in order, that part a cube's inside corners from the others.

    Corner k stands at (k >> 2 & 1, k >> 1 & 1, k & 1). On a face with four crossings each inside corner is cut off alone."""
    links: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for axis in range(3):
        p, q = (1 << b for b in range(3) if b != axis)
        for side in (0, 1 << axis):
            ring = [side, side | p, side | p | q, side | q]
            edges = [tuple(sorted((ring[i], ring[(i + 1) % 4]))) for i in range(4)]
            crossed = [i for i in range(4) if inside[edges[i][0]] != inside[edges[i][1]]]
            pairs = [crossed] if len(crossed) == 2 else [[(i - 1) % 4, i] for i in range(4) if inside[ring[i]]] if crossed else []
            for i, j in pairs:
                links.setdefault(edges[i], []).append(edges[j])
                links.setdefault(edges[j], []).append(edges[i])
    out, left = [], set(links)
    while left:
        at = min(left)
        loop, last = [], None
        while at in left:
            left.remove(at)
            loop.append(at)
            last, at = at, next((e for e in links[at] if e != last and e in left), None)
        out.append(loop)
    return out


def surface_table(spacing: tuple[float, float, float]) -> list[float]:
    """The surface within a cube for each of its 256 states, through the middles of the crossed edges, as fans of triangles."""
    corner = np.array([[k >> 2 & 1, k >> 1 & 1, k & 1] for k in range(8)]) * np.array(spacing)
    areas = []
    for state in range(256):
        total = 0.0
        for loop in _loops(tuple(bool(state >> k & 1) for k in range(8))):
            points = np.array([(corner[a] + corner[b]) / 2 for a, b in loop])
            total += sum(float(np.linalg.norm(np.cross(points[i] - points[0], points[i + 1] - points[0]))) / 2 for i in range(1, len(points) - 1))
        areas.append(total)
    return areas


SURFACES = "image_id long, t int, set_index int, label long, surface_area_um2 double, volume_um3 double"


def surfaces(labels: DataFrame, scales: DataFrame) -> DataFrame:
    """Surface and volume of volumes by marching cubes, in the units of their image's scales (image_id, sz, sy, sx); null if a
    scale is missing, or the object is flat. The states of all cubes around an object's voxels are counted in the JVM; a count by
    state is what Python weighs with areas. Ambiguous faces part the object; other conventions differ by a few parts in a
    hundred there."""
    steps = F.explode(F.array(*(F.struct(F.lit(k >> 2 & 1).alias("dz"), F.lit(k >> 1 & 1).alias("dy"), F.lit(k & 1).alias("dx"), F.lit(1 << k).alias("w")) for k in range(8))))
    moved = labels.select(*OBJECT, "z", "y", "x", steps.alias("s")).select(*OBJECT, (F.col("z") - F.col("s.dz")).alias("z"), (F.col("y") - F.col("s.dy")).alias("y"), (F.col("x") - F.col("s.dx")).alias("x"), "s.w")
    states = moved.groupBy(*OBJECT, "z", "y", "x").agg(F.sum("w").alias("state"))
    counted = states.groupBy(*OBJECT, "state").agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high"))
    # an object of one plane has cubes at two heights
    deep = counted.groupBy(*OBJECT).agg(F.collect_list(F.struct("state", "n")).alias("states"), (F.max("high") - F.min("low")).alias("planes")).filter("planes > 1").drop("planes")

    def work(batches):
        tables: dict[tuple, np.ndarray] = {}
        for batch in batches:
            out = []
            for states, *spacing in zip(*(batch.column(i).to_pylist() for i in range(4, 8)), strict=True):
                if None in spacing:
                    out.append((None, None))
                    continue
                if tuple(spacing) not in tables:
                    if len(tables) > 64:
                        tables.clear()
                    tables[tuple(spacing)] = np.array(surface_table(tuple(spacing)))
                state, n = (np.array([x[k] for x in states], np.int64) for k in ("state", "n"))
                corners = np.unpackbits(state.astype(np.uint8)[:, None], axis=1).sum(axis=1, dtype=np.int64)
                out.append((float((tables[tuple(spacing)][state] * n).sum()), float((corners * n).sum() / 8 * np.prod(spacing))))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *(pa.array([r[i] for r in out], pa.float64()) for i in range(2))], names=[c.split(" ")[0] for c in SURFACES.split(", ")])

    return deep.join(scales.select("image_id", "sz", "sy", "sx").hint("merge"), "image_id").select(*OBJECT, "states", "sz", "sy", "sx").mapInArrow(work, SURFACES)
