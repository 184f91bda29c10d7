"""The queries' results as SQL for DuckDB over the same Parquet tables."""

from __future__ import annotations

BASE = """WITH img AS (SELECT CAST(s_suppkey AS BIGINT) AS image_id, r_name AS plate_row, n_name AS plate_column,
    CASE WHEN s_suppkey % 7 <> 0 THEN 0.5::DOUBLE END AS sy, CASE WHEN s_suppkey % 7 <> 0 THEN 0.25::DOUBLE END AS sx, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 THEN 1.5::DOUBLE END AS sz
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
grid AS (SELECT image_id, a.y, b.x FROM img, range(32) a(y), range(32) b(x)),
sig AS (SELECT CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_orderkey % 32 AS BIGINT) AS y, CAST(l_partkey % 32 AS BIGINT) AS x, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2, 3),
pixels AS (SELECT image_id, k AS channel_index, y, x, CAST(CASE WHEN k = 1 THEN coalesce(v, 0) ELSE y * 32 + x END AS DOUBLE) AS value
    FROM grid LEFT JOIN sig USING (image_id, y, x), (VALUES (1), (2)) c(k)),
marked AS (SELECT *, CASE WHEN y % 8 BETWEEN 1 AND 6 AND x % 8 BETWEEN 1 AND 5 + image_id % 2 THEN (y // 8) * 4 + x // 8 + 1 END AS cell,
    CASE WHEN (y + image_id % 3) % 8 BETWEEN 3 AND 5 AND (x + image_id % 5) % 8 BETWEEN 2 AND 4 THEN ((y + image_id % 3) // 8) * 5 + (x + image_id % 5) // 8 + 1 END AS nucleus FROM grid),
labels AS (SELECT image_id, 1 AS set_index, CAST(cell AS BIGINT) AS label, y, x FROM marked WHERE cell IS NOT NULL
    UNION ALL SELECT image_id, 2, CAST(nucleus AS BIGINT), y, x FROM marked WHERE nucleus IS NOT NULL
    UNION ALL SELECT image_id, 3, CAST(cell AS BIGINT), y, x FROM marked WHERE cell IS NOT NULL AND nucleus IS NULL
    UNION ALL SELECT image_id, 4, y * 32 + x + 1, y, x FROM sig WHERE v >= 100),
obj AS (SELECT image_id, set_index, label, count(*) AS n, avg(y) AS cy, avg(x) AS cx, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1,
    round(var_pop(y), 9) AS vy, round(var_pop(x), 9) AS vx, round(covar_pop(y, x), 9) + 0.0 AS vyx FROM labels GROUP BY 1, 2, 3),
objs AS (SELECT obj.*, sy, sx, sz, plate_row, plate_column FROM obj JOIN img USING (image_id))
"""


def sql(body: str, *doubles: str, base: str = BASE) -> str:
    """The body over the raster's tables, with the doubles rounded to six places."""
    shown = ", ".join(f"round({d}, 6) + 0.0 AS {d}" for d in doubles)
    return f"{base}SELECT * {f'REPLACE ({shown})' if shown else ''} FROM ({body}) result"


def with_more(tables: str) -> str:
    return BASE.rstrip() + ",\n" + tables + "\n"


OVERLAPS = with_more("""one AS (SELECT a.image_id, a.set_index AS ss, a.label AS sl, b.set_index AS ts, b.label AS tl, count(*) AS n FROM labels a JOIN labels b USING (image_id, y, x) WHERE a.set_index <> b.set_index GROUP BY 1, 2, 3, 4, 5),
rel AS (SELECT one.image_id, 0 AS t, ss AS source_set, sl AS source_label, ts AS target_set, tl AS target_label,
    CASE WHEN one.n = s.n AND one.n = g.n THEN 'identical_extent' WHEN one.n = s.n THEN 'inside' WHEN one.n = g.n THEN 'contains' ELSE 'overlaps' END AS relation,
    one.n AS overlap_voxels, one.n * s.sy * s.sx AS overlap_um2, CAST(NULL AS DOUBLE) AS overlap_um3, one.n / s.n AS source_overlap_fraction, one.n / g.n AS target_overlap_fraction,
    EXISTS (SELECT 1 FROM labels l WHERE l.image_id = one.image_id AND l.set_index = ts AND l.label = tl AND l.y = CAST(round_even(s.cy, 0) AS BIGINT) AND l.x = CAST(round_even(s.cx, 0) AS BIGINT)) AS source_centroid_in_target,
    sqrt(power((s.cy - g.cy) * s.sy, 2) + power((s.cx - g.cx) * s.sx, 2)) AS centroid_distance_um,
    one.n = max(one.n) OVER (PARTITION BY one.image_id, ss, sl, ts) AS is_primary_for_source
    FROM one JOIN objs s ON s.image_id = one.image_id AND s.set_index = ss AND s.label = sl JOIN objs g ON g.image_id = one.image_id AND g.set_index = ts AND g.label = tl)""")

MATCH = with_more("""pairs AS (SELECT c.image_id, c.label AS cell, n.label AS nucleus, count(*) AS k FROM labels c JOIN labels n USING (image_id, y, x) WHERE c.set_index = 1 AND n.set_index = 2 GROUP BY 1, 2, 3),
home AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY image_id, nucleus ORDER BY k DESC, cell) = 1),
chosen AS (SELECT home.image_id, cell, nucleus FROM home JOIN obj o ON o.image_id = home.image_id AND o.set_index = 2 AND o.label = nucleus QUALIFY row_number() OVER (PARTITION BY home.image_id, cell ORDER BY o.n DESC, nucleus) = 1),
ids AS (SELECT *, dense_rank() OVER (PARTITION BY image_id ORDER BY cell) AS new_id FROM chosen),
nc AS (SELECT l.image_id, y, x, new_id FROM labels l JOIN ids ON l.image_id = ids.image_id AND l.label = cell WHERE set_index = 1),
nn AS (SELECT l.image_id, y, x, new_id FROM labels l JOIN ids ON l.image_id = ids.image_id AND l.label = nucleus WHERE set_index = 2)""")
