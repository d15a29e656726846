"""DuckDB SQL for the queries, over the same tables."""

from __future__ import annotations

from . import views as v
from ..functions.parsing import MPP_PATTERNS, SUFFIXES

T = f"{v.TARGET}::DOUBLE"
SLIDES = f"""slides AS (SELECT slide_id, width0, height0, mpp_x, mpp_y, bnd_x::INT AS bnd_x, bnd_y::INT AS bnd_y, bnd_w::INT AS bnd_w, bnd_h::INT AS bnd_h FROM ({v.SLIDES.format(div="//", part="part")}))"""
FRAMES = f"""{SLIDES}, frame0 AS (SELECT *, coalesce(bnd_x, 0) AS origin_x, coalesce(bnd_y, 0) AS origin_y, coalesce(bnd_w, width0) AS frame_w, coalesce(bnd_h, height0) AS frame_h FROM slides),
frame1 AS (SELECT *, greatest(1, round_even(frame_w * mpp_x / {T}, 0)::INT) AS out_w, greatest(1, round_even(frame_h * mpp_y / {T}, 0)::INT) AS out_h FROM frame0),
frames AS (SELECT *, frame_w * mpp_x / out_w AS ampp_x, frame_h * mpp_y / out_h AS ampp_y FROM frame1)"""


def _axis(length: str, patch: int, stride: int) -> str:
    return f"CASE WHEN {length} <= {patch} THEN [0] ELSE list_distinct(list_append(range(0, {length} - {patch} + 1, {stride}), {length} - {patch})) END"


GRID = f"""{FRAMES}, ys AS (SELECT *, unnest({_axis("out_h", v.PATCH, v.STRIDE)})::INT AS out_y FROM frames), grid AS (SELECT *, unnest({_axis("out_w", v.PATCH, v.STRIDE)})::INT AS out_x FROM ys)"""
P, H = v.PATCH, v.HALO
CROPS = f"""{GRID}, crop0 AS (SELECT *, CASE WHEN out_x = 0 THEN 0 ELSE {H} END AS crop_left, CASE WHEN out_y = 0 THEN 0 ELSE {H} END AS crop_top,
  CASE WHEN out_x + {P} >= out_w THEN {P} ELSE {P - H} END AS crop_right, CASE WHEN out_y + {P} >= out_h THEN {P} ELSE {P - H} END AS crop_bottom FROM grid),
crop1 AS (SELECT *, out_x + crop_left AS gx1, out_y + crop_top AS gy1, least(out_x + crop_right, out_w) AS gx2, least(out_y + crop_bottom, out_h) AS gy2 FROM crop0),
planned AS (SELECT *, (origin_x + floor(gx1 * ampp_x / mpp_x))::INT AS lx1, (origin_y + floor(gy1 * ampp_y / mpp_y))::INT AS ly1,
  (origin_x + ceil(gx2 * ampp_x / mpp_x))::INT AS lx2, (origin_y + ceil(gy2 * ampp_y / mpp_y))::INT AS ly2,
  out_x = 0 OR out_y = 0 OR out_x + {P} >= out_w OR out_y + {P} >= out_h AS edge, out_x + {P} > out_w OR out_y + {P} > out_h AS padded
  FROM crop1 WHERE gx2 > gx1 AND gy2 > gy1)"""
TILES = f"""{GRID}, tiles AS (SELECT slide_id, (out_x // {v.TILE})::INT AS kx, (out_y // {v.TILE})::INT AS ky, min(out_x) AS tile_x, min(out_y) AS tile_y, max(out_x) + {P} - min(out_x) AS tile_w,
  max(out_y) + {P} - min(out_y) AS tile_h, count(*) AS n_patches, string_agg(out_y || ':' || out_x, ',' ORDER BY out_y, out_x) AS patches FROM grid GROUP BY ALL)"""


def _summary(grid: str, kept: str) -> str:
    cell = f"(out_x // {v.TILE})::VARCHAR || ':' || (out_y // {v.TILE})::VARCHAR"
    return f"""SELECT t.slide_id, total_grid, coalesce(candidates, 0) AS candidates, coalesce(edge_patches, 0) AS edge_patches, coalesce(padded_patches, 0) AS padded_patches, coalesce(supertiles, 0) AS supertiles
FROM (SELECT slide_id, count(*) AS total_grid FROM {grid} GROUP BY 1) t LEFT JOIN (SELECT slide_id, count(*) AS candidates, (count(*) FILTER (edge)) AS edge_patches,
  (count(*) FILTER (padded)) AS padded_patches, count(DISTINCT {cell}) AS supertiles FROM {kept} GROUP BY 1) c USING (slide_id)"""


LEVELS = f"""{SLIDES}, levels AS (SELECT slide_id, i - 1 AS index, d AS downsample, mpp_x * d AS mpp_x, mpp_y * d AS mpp_y FROM slides, (SELECT unnest(range(1, 6)) AS i, unnest([1.0, 2.0, 4.0, 8.0, 16.0]::DOUBLE[]) AS d))"""
NEAR = f"SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY greatest(abs(mpp_x - {T}), abs(mpp_y - {T})), index) AS rk FROM levels"


def _finer(cap: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY (mpp_x + mpp_y) / 2 DESC, index) AS rk FROM levels WHERE mpp_x <= {T} AND mpp_y <= {T}{cap}"


BOUNDED = f" AND greatest({T} / mpp_x, {T} / mpp_y) <= 2.0"


def _chosen(policy: str | None) -> str:
    if policy is None:
        return f"{LEVELS}, chosen AS (SELECT * FROM ({NEAR}) WHERE rk = 1)"
    return f"{LEVELS}, near AS (SELECT * FROM ({NEAR}) WHERE rk = 1), fine AS (SELECT * FROM ({_finer(policy)}) WHERE rk = 1), chosen AS (SELECT * FROM fine UNION ALL SELECT * FROM near WHERE slide_id NOT IN (SELECT slide_id FROM fine))"


def _level(policy: str | None) -> str:
    return f"WITH {_chosen(policy)} SELECT slide_id, index::INT AS level, mpp_x AS level_mpp_x, round(abs(mpp_x - {T}), 6) AS error_x, round({T} / mpp_x, 6) AS resize_x, round({T} / mpp_y, 6) AS resize_y, round(greatest({T} / mpp_x, {T} / mpp_y), 6) AS oversample FROM chosen"


def _nth(values: list[str], key: str = "slide_id") -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in values) + f"][({key} % {len(values)} + 1)::INT]"


def _number(x: str) -> str:
    plain = f"CASE WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(trim({x}) AS DOUBLE) END"
    part = lambda i: f"try_cast(regexp_extract(trim({x}), '^([0-9]+(?:\\.[0-9]+)?)\\s*/\\s*([0-9]+(?:\\.[0-9]+)?)$', {i}) AS DOUBLE)"
    return f"coalesce({plain}, {part(1)} / nullif({part(2)}, 0))"


def _text(x: str) -> str:
    return "coalesce(" + ", ".join(f"try_cast(nullif(regexp_extract({x}, '(?i){p}', 1), '') AS DOUBLE)" for p in MPP_PATTERNS) + ")"


THUMBS = f"""{SLIDES}, spot AS (SELECT slide_id, tx::INT AS tx, ty::INT AS ty, slide_id % 7 AS sh FROM slides, (SELECT unnest(range({v.THUMB_W})) AS tx), (SELECT unnest(range({v.THUMB_H})) AS ty)),
kinds AS (SELECT *, tx >= 2 + sh AND tx < 9 + sh AND ty >= 2 AND ty < 8 AS rect, ty >= 9 AND ty < 11 AS band, (tx * 31 + ty * 17 + slide_id * 13) % 256 AS nz FROM spot),
thumbs AS (SELECT slide_id, tx, ty, {", ".join(f"(CASE WHEN rect THEN {full} WHEN band THEN nz * {k} % 256 ELSE 250 + (tx + ty) % 6 END)::INT AS {n}" for n, full, k in (("r", 180, 1), ("g", 60, 7), ("b", 120, 3)))} FROM kinds),
hsv AS (SELECT slide_id, tx, ty, ((r * 19595 + g * 38470 + b * 7471 + 32768) >> 16)::INT AS gray,
  (CASE WHEN greatest(r, g, b) = least(r, g, b) THEN 0 ELSE floor(((greatest(r, g, b) - least(r, g, b))::DOUBLE / greatest(r, g, b)::DOUBLE)::FLOAT::DOUBLE * 255) END)::INT AS sat, greatest(r, g, b) AS val FROM thumbs)"""
OTSU = f"""{THUMBS}, hist AS (SELECT slide_id, gray, count(*)::BIGINT AS n FROM hsv GROUP BY ALL),
cum AS (SELECT slide_id, gray, (sum(n) OVER u)::BIGINT AS wb, (sum(gray * n) OVER u)::BIGINT AS sb, (sum(n) OVER w)::BIGINT AS total, (sum(gray * n) OVER w)::BIGINT AS al FROM hist
  WINDOW u AS (PARTITION BY slide_id ORDER BY gray ROWS UNBOUNDED PRECEDING), w AS (PARTITION BY slide_id)),
sep AS (SELECT *, wb::DOUBLE * (total - wb) * (sb / wb - (al - sb) / (total - wb)) * (sb / wb - (al - sb) / (total - wb)) AS between_ FROM cum WHERE total > wb),
top AS (SELECT slide_id, gray FROM (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY between_ DESC, gray) AS rk FROM sep) WHERE rk = 1),
otsu AS (SELECT DISTINCT h.slide_id, coalesce(top.gray, 0) AS otsu FROM hist h LEFT JOIN top USING (slide_id))"""
MASK = f"{OTSU}, mask0 AS (SELECT slide_id, tx, ty, (gray < otsu OR (sat >= 18 AND val < 235))::INT AS mask FROM hsv JOIN otsu USING (slide_id))"


def _morphology() -> str:
    out, n = [], 0
    for f, r in (("max", 2), ("min", 2), ("min", 1), ("max", 1)):
        for line, along in (("ty", "tx"), ("tx", "ty")):
            out.append(f"mask{n + 1} AS (SELECT slide_id, tx, ty, {f}(mask) OVER (PARTITION BY slide_id, {line} ORDER BY {along} ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS mask FROM mask{n})")
            n += 1
    return ", ".join(out)


CLEAN = f"{MASK}, {_morphology()}"
FRACTION = f"""{CLEAN}, {CROPS.removeprefix(SLIDES + ", ")}, rect AS (SELECT *, least(greatest(floor(lx1 * {v.THUMB_W} / width0), 0), {v.THUMB_W})::INT AS tx1, least(greatest(ceil(lx2 * {v.THUMB_W} / width0), 0), {v.THUMB_W})::INT AS tx2,
  least(greatest(floor(ly1 * {v.THUMB_H} / height0), 0), {v.THUMB_H})::INT AS ty1, least(greatest(ceil(ly2 * {v.THUMB_H} / height0), 0), {v.THUMB_H})::INT AS ty2 FROM planned),
frac AS (SELECT r.slide_id, r.out_x, r.out_y, any_value(r.edge) AS edge, any_value(r.padded) AS padded, coalesce(avg(m.mask::DOUBLE), 0.0) AS fraction FROM rect r LEFT JOIN mask8 m
  ON m.slide_id = r.slide_id AND m.tx >= tx1 AND m.tx < tx2 AND m.ty >= ty1 AND m.ty < ty2 GROUP BY 1, 2, 3)"""
S, SH, SS, SC, ST = v.SMALL, v.SMALL_HALO, v.SMALL_STRIDE, v.CANVAS, v.SMALL_TILE
STITCH = f"""cells AS (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS rn FROM embeddings),
spots AS (SELECT (label * 1000 + rn // 49)::INT AS canvas, embedding, CASE WHEN rn % 7 = 6 THEN {SC - S} ELSE (rn % 49 % 7) * {SS} END AS out_x, CASE WHEN rn % 49 // 7 = 6 THEN {SC - S} ELSE (rn % 49 // 7) * {SS} END AS out_y FROM cells),
pix AS (SELECT canvas, out_x, out_y, unnest(range({S * S})) AS i, unnest(embedding)::DOUBLE AS z FROM spots),
pos AS (SELECT canvas, out_x // {ST} AS kx, out_y // {ST} AS ky, out_x, out_y, i % {S} AS lx, i // {S} AS ly, ((1 / (1 + exp(-z)))::FLOAT >= 0.5::FLOAT)::INT AS value FROM pix),
wr AS (SELECT canvas, (out_x + lx)::INT AS x, (out_y + ly)::INT AS y, value, row_number() OVER (PARTITION BY canvas, out_x + lx, out_y + ly ORDER BY kx DESC, ky DESC, out_y DESC, out_x DESC) AS rk FROM pos
  WHERE lx >= CASE WHEN out_x = 0 THEN 0 ELSE {SH} END AND lx < CASE WHEN out_x + {S} >= {SC} THEN {S} ELSE {S - SH} END
    AND ly >= CASE WHEN out_y = 0 THEN 0 ELSE {SH} END AND ly < CASE WHEN out_y + {S} >= {SC} THEN {S} ELSE {S - SH} END AND out_x + lx < {SC} AND out_y + ly < {SC}),
stitch AS (SELECT canvas, x, y, value AS mask FROM wr WHERE rk = 1)"""
RUNS = """runs AS (SELECT 'slide_' || (o_custkey % 50) AS slide_stem, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || '_' || o_orderkey AS run_id, o_orderkey % 9000 + 100 AS grid_patches,
  o_orderkey % 900 + 10 AS candidate_patches, (o_orderkey % 128)::DOUBLE AS wall_seconds, (o_orderkey % 128)::DOUBLE / 2 AS processing_seconds FROM orders)"""


def _chain() -> str:
    arms = []
    for k, props in v.PROPS.items():
        p = {a.lower(): f"'{b}'" for a, b in props.items()}
        num = lambda key: _number(p[key]) if key in p else "NULL::DOUBLE"
        if k in (0, 7):
            x, y, label = num("openslide.mpp-x"), num("openslide.mpp-y"), "openslide.mpp-x/y"
        elif k == 1:
            x = y = num("mpp_x")
            label = "openslide.mpp-x/y"
        elif k == 2:
            x = y = num("aperio.mpp")
            label = "aperio.MPP"
        elif k == 3:
            x = y = _text(p["openslide.comment"])
            label = "text:openslide.comment"
        elif k in (4, 5):
            u = "25400.0::DOUBLE" if k == 4 else "10000.0::DOUBLE"
            x, y, label = f"{u} / {num('tiff.xresolution')}", f"{u} / coalesce({num('tiff.yresolution')}, {num('tiff.xresolution')})", "tiff.resolution"
        else:
            x = y = f"10.0::DOUBLE / {num('aperio.appmag')}"
            label = "objective-power-estimate"
        arms.append(f"SELECT slide_id, {x} AS x, {y} AS y, '{label}' AS mpp_source FROM slides WHERE slide_id % 8 = {k}")
    return f"WITH {SLIDES} SELECT slide_id, round(coalesce(x, y), 9) AS mpp_x, round(coalesce(y, x), 9) AS mpp_y, mpp_source FROM ({' UNION ALL '.join(arms)})"


def _bytes(n: str) -> str:
    arms = " ".join(f"WHEN {n} < {1024 ** (k + 1)} THEN format('{{:.2f}} {u}', {n}::DOUBLE / {1024**k}::DOUBLE)" for k, u in enumerate(("B", "KiB", "MiB", "GiB")))
    return f"CASE {arms} ELSE format('{{:.2f}} TiB', {n}::DOUBLE / {1024**4}::DOUBLE) END"


SHA = f"nullif(substr(trim({_nth(['4e5e3cf77a', ' 9a9d5cc8e1 ', '', '   '], 'o_orderkey')}), 1, 7), '')"
FLAG = f"lower(trim({_nth(['1', ' True ', 'off', 'NO', 'maybe', '', 'y', 'n'])}))"
NAME = f"'slide_' || slide_id || {_nth(['.SVS', '.tiff', '.txt', '.mrxs', '.json', '.NDPI', '.tif.bak'])}"
COLOUR = f"ltrim({_nth(['#ff8000', '00FF7f', '#12345', 'zz0000', ''])}, '#')"
_hex = lambda i: f"CASE WHEN regexp_full_match(c, '[0-9a-fA-F]{{6}}') THEN ('0x' || substr(c, {i}, 2))::INT ELSE 255 END"
_place = lambda c, full, t: f"round_even({c} * {t} / {full}, 0)::INT"
_halves = f"WITH RECURSIVE {FRAMES}, h AS (SELECT slide_id, out_w AS w, out_h AS h, 0 AS n FROM frames UNION ALL SELECT slide_id, (w + 1) // 2, (h + 1) // 2, n + 1 FROM h WHERE least(w, h) >= 512)"

ORACLE_SQL = {
    "q_output_frame": f"WITH {FRAMES} SELECT slide_id, origin_x, origin_y, frame_w, frame_h, out_w, out_h, ampp_x, ampp_y FROM frames",
    "q_output_shape": f"WITH {SLIDES} SELECT slide_id, greatest(1, round_even(width0 * mpp_x / {T}, 0)::INT) AS out_w, greatest(1, round_even(height0 * mpp_y / {T}, 0)::INT) AS out_h FROM slides",
    "q_plan_grid": f"WITH {GRID} SELECT slide_id, out_x, out_y FROM grid",
    "q_crop_bounds": f"WITH {CROPS} SELECT slide_id, out_x, out_y, crop_left, crop_top, crop_right, crop_bottom, gx1, gy1, gx2, gy2, lx1, ly1, lx2, ly2, edge, padded FROM planned",
    "q_roi_filter": f"WITH {CROPS} SELECT slide_id, out_x, out_y FROM planned WHERE NOT (gx2 <= floor(out_w / 4) OR gy2 <= floor(out_h / 4) OR gx1 >= floor(out_w * 3 / 4) OR gy1 >= floor(out_h * 3 / 4))",
    "q_supertiles": f"WITH {TILES} SELECT slide_id, kx, ky, tile_x, tile_y, tile_w, tile_h, n_patches, patches FROM tiles",
    "q_planning_summary": f"WITH {CROPS} {_summary('planned', 'planned')}",
    "q_planning_ratios": f"WITH {CROPS} SELECT *, round(candidates / greatest(total_grid, 1), 6) AS candidate_over_grid, round(candidates / greatest(supertiles, 1), 6) AS candidates_per_supertile FROM ({_summary('planned', 'planned')})",
    "q_batch_stats": f"WITH {TILES} SELECT slide_id, sum(ceil(n_patches / 8))::BIGINT AS num_batches, sum(n_patches)::BIGINT AS total_items, round(sum(n_patches)::DOUBLE / greatest(sum(ceil(n_patches / 8)), 1), 6) AS mean_fill FROM tiles GROUP BY 1",
    "q_levels_unnest": f"WITH {LEVELS} SELECT slide_id, index::INT AS index, downsample, mpp_x, mpp_y FROM levels",
    "q_level_select_nearest": _level(None),
    "q_level_select_prefer_higher": _level(""),
    "q_level_select_bounded": _level(BOUNDED),
    "q_read_addresses": f"""WITH {TILES}, {_chosen(BOUNDED).removeprefix(SLIDES + ", ")} SELECT t.slide_id, kx, ky, (origin_x + round_even(tile_x * ampp_x / f.mpp_x, 0))::INT AS read_x, (origin_y + round_even(tile_y * ampp_y / f.mpp_y, 0))::INT AS read_y,
      greatest(1, round_even(tile_w * ampp_x / c.mpp_x, 0)::INT) AS read_w, greatest(1, round_even(tile_h * ampp_y / c.mpp_y, 0)::INT) AS read_h FROM tiles t JOIN frames f USING (slide_id) JOIN chosen c USING (slide_id)""",
    "q_coord_backmap": f"WITH {GRID} SELECT slide_id, out_x, out_y, round(origin_x + out_x * ampp_x / mpp_x, 6) AS x_l0, round(origin_y + out_y * ampp_y / mpp_y, 6) AS y_l0 FROM grid",
    "q_mpp_chain": _chain(),
    "q_mpp_text": f"WITH {SLIDES} SELECT slide_id, {_text(_nth(v.TEXTS))} AS mpp FROM slides",
    "q_lenient_float": f"WITH {SLIDES} SELECT slide_id, {_number(_nth(v.NUMBERS))} AS number FROM slides",
    "q_mpp_override": f"""WITH {SLIDES}, o AS (SELECT *, CASE WHEN slide_id % 4 IN (1, 3) THEN 0.75::DOUBLE END AS ox, CASE WHEN slide_id % 4 IN (2, 3) THEN 0.7::DOUBLE END AS oy FROM slides)
      SELECT slide_id, coalesce(ox, oy, mpp_x) AS mpp_x, coalesce(oy, ox, mpp_y) AS mpp_y, CASE WHEN coalesce(ox, oy) IS NULL THEN 'file' ELSE 'config.override' END AS mpp_source FROM o""",
    "q_vendor": f"WITH {SLIDES} SELECT slide_id, CASE slide_id % 4 WHEN 0 THEN 'aperio' WHEN 1 THEN 'mirax' WHEN 2 THEN 'generic-image' END AS vendor FROM slides",
    "q_bounds": f"WITH {SLIDES} SELECT slide_id, bnd_x AS x, bnd_y AS y, bnd_w AS width, bnd_h AS height FROM slides",
    "q_background": f"WITH {SLIDES}, t AS (SELECT slide_id, {COLOUR} AS c FROM slides) SELECT slide_id, {_hex(1)} AS r, {_hex(3)} AS g, {_hex(5)} AS b, 255 AS a FROM t",
    "q_tile_option": f"WITH {FRAMES} SELECT slide_id, CASE WHEN slide_id % 3 * 512 > 0 AND out_w >= slide_id % 3 * 512 AND out_h >= slide_id % 3 * 512 THEN (slide_id % 3 * 512)::INT END AS tile FROM frames",
    "q_resolution_tag": f"WITH {FRAMES} SELECT slide_id, round(10000.0::DOUBLE / ampp_x, 6) AS x_per_cm, round(10000.0::DOUBLE / ampp_y, 6) AS y_per_cm FROM frames",
    "q_pyramid_levels": f"{_halves} SELECT slide_id, max(n) AS levels FROM h GROUP BY 1",
    "q_preview_placement": f"WITH {FRAMES} SELECT slide_id, {_place('origin_x', 'width0', 1536)} AS paste_x, {_place('origin_y', 'height0', 1024)} AS paste_y, greatest(1, {_place('frame_w', 'width0', 1536)}) AS paste_w, greatest(1, {_place('frame_h', 'height0', 1024)}) AS paste_h FROM frames",
    "q_gray_hsv": f"WITH {THUMBS} SELECT slide_id, tx, ty, gray, sat, val FROM hsv",
    "q_gray_histogram": f"WITH {OTSU} SELECT slide_id, gray, n FROM hist",
    "q_otsu": f"WITH {OTSU} SELECT slide_id, otsu FROM otsu",
    "q_tissue_mask": f"WITH {MASK} SELECT slide_id, tx, ty, mask FROM mask0",
    "q_morphology": f"WITH {CLEAN} SELECT slide_id, tx, ty, mask FROM mask8",
    "q_integral": f"""WITH {CLEAN}, rs AS (SELECT *, sum(mask) OVER (PARTITION BY slide_id, ty ORDER BY tx ROWS UNBOUNDED PRECEDING) AS rw FROM mask8)
      SELECT slide_id, tx, ty, (sum(rw) OVER (PARTITION BY slide_id, tx ORDER BY ty ROWS UNBOUNDED PRECEDING))::INT AS integral FROM rs""",
    "q_tissue_fraction": f"WITH {FRACTION} SELECT slide_id, out_x, out_y, round(fraction, 6) AS fraction FROM frac",
    "q_gated_plan": f"WITH {FRACTION}, kept AS (SELECT * FROM frac WHERE fraction >= 0.2) {_summary('frac', 'kept')}",
    "q_prob_threshold": "WITH p AS (SELECT vec_id, unnest(range(64))::INT AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT vec_id, i, round(1 / (1 + exp(-x)), 6) AS prob, ((1 / (1 + exp(-x)))::FLOAT >= 0.5::FLOAT)::INT AS mask FROM p",
    "q_softmax_threshold": "WITH p AS (SELECT vec_id, unnest(range(32))::INT AS i, unnest(embedding[1:32])::DOUBLE AS a, unnest(embedding[33:64])::DOUBLE AS b FROM embeddings) SELECT vec_id, i, round(1 / (1 + exp(-(b - a))), 6) AS prob, ((1 / (1 + exp(-(b - a))))::FLOAT >= 0.5::FLOAT)::INT AS mask FROM p",
    "q_stitch": f"WITH {STITCH} SELECT canvas, x, y, mask FROM stitch",
    "q_mask_255": f"WITH {STITCH} SELECT canvas, x, y, mask * 255 AS value FROM stitch",
    "q_mask_area": f"WITH {STITCH} SELECT canvas, sum(mask)::BIGINT AS area, count(*) AS written FROM stitch GROUP BY 1",
    "q_pyramid": f"""WITH RECURSIVE {STITCH}, size AS (SELECT canvas, max(x) + 1 AS w, max(y) + 1 AS h FROM stitch GROUP BY 1), lv AS (SELECT canvas, w, h, 0 AS level FROM size
      UNION ALL SELECT canvas, (w + 1) // 2, (h + 1) // 2, level + 1 FROM lv WHERE least(w, h) >= 4)
      SELECT s.canvas, level, (x // (1 << level))::INT AS x, (y // (1 << level))::INT AS y, mask FROM stitch s JOIN lv USING (canvas) WHERE x % (1 << level) = 0 AND y % (1 << level) = 0""",
    "q_preview_nearest": f"""WITH {STITCH}, g AS (SELECT canvas, px::INT AS px, py::INT AS py, floor((px + 0.5::DOUBLE) * {SC} / 20)::INT AS x, floor((py + 0.5::DOUBLE) * {SC} / 17)::INT AS y FROM (SELECT DISTINCT canvas FROM spots), (SELECT unnest(range(20)) AS px), (SELECT unnest(range(17)) AS py))
      SELECT g.canvas, px, py, coalesce(mask, 0) * 255 AS value FROM g LEFT JOIN stitch USING (canvas, x, y)""",
    "q_progress_sampling": """WITH n AS (SELECT user_id AS run_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx, count(*) OVER (PARTITION BY user_id) AS total FROM events)
      SELECT run_id, event_id, idx, total FROM n WHERE idx = 1 OR idx = total OR idx % 8 = 0""",
    "q_event_counts": "SELECT user_id AS run_id, event_type AS event, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY ALL",
    "q_run_throughput": f"WITH {RUNS} SELECT run_id, " + ", ".join(f"round({k}_patches / greatest({s}_seconds, 1e-9::DOUBLE), 6) AS {k}_per_{s}_second" for k in ("grid", "candidate") for s in ("wall", "processing")) + " FROM runs",
    "q_batch_summary": f"WITH {RUNS} SELECT slide_stem, run_id, grid_patches, candidate_patches, round(wall_seconds, 6) AS wall_seconds, round(processing_seconds, 6) AS processing_seconds, round(candidate_patches / greatest(wall_seconds, 1e-9::DOUBLE), 6) AS candidates_per_second FROM runs",
    "q_latest_runs": f"WITH {RUNS} SELECT slide_stem, run_id, grid_patches, wall_seconds FROM (SELECT *, row_number() OVER (PARTITION BY slide_stem ORDER BY run_id DESC) AS rk FROM runs) WHERE rk = 1",
    "q_format_bytes": f"WITH n AS (SELECT o_orderkey, (o_orderkey * [1, 512, 65536, 16777216, 4294967296][(o_orderkey % 5 + 1)::INT])::BIGINT AS n FROM orders) SELECT o_orderkey, {_bytes('n')} AS size FROM n",
    "q_utc_ts": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS stamp FROM orders",
    "q_run_id": f"SELECT o_orderkey, {SHA} AS sha, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || '_' || coalesce({SHA}, 'nogit') || '_9a9d5cc8' AS run_id FROM orders",
    "q_env_bool": f"WITH {SLIDES} SELECT slide_id, CASE WHEN {FLAG} IN ('1', 'true', 'yes', 'y', 'on') THEN true WHEN {FLAG} IN ('0', 'false', 'no', 'n', 'off') THEN false END AS flag FROM slides",
    "q_suffix_filter": f"WITH {SLIDES}, n AS (SELECT slide_id, {NAME} AS name FROM slides) SELECT slide_id, name FROM n WHERE " + " OR ".join(f"ends_with(lower(name), '{x}')" for x in SUFFIXES),
    "q_output_kind": f"WITH {SLIDES} SELECT slide_id, ['binary_logits_1ch', 'binary_logits_2ch', 'hw', 'unknown'][slide_id % 4 + 1] AS kind FROM slides",
    "q_export_gates": f"WITH {SLIDES} SELECT slide_id, slide_id % 2 = 0 OR slide_id % 3 = 0 OR slide_id % 5 = 0 AS exports_requested, slide_id % 2 = 0 OR slide_id % 3 = 0 AS needs_mask FROM slides",
    "q_stitch_chunks": f"""WITH {STITCH}, c AS (SELECT DISTINCT canvas, cx, cy FROM (SELECT canvas, x // 16 AS cx, y // 16 AS cy FROM stitch)), g AS (SELECT canvas, (cx * 16 + dx)::INT AS x, (cy * 16 + dy)::INT AS y FROM c, (SELECT unnest(range(16)) AS dx), (SELECT unnest(range(16)) AS dy))
      SELECT g.canvas, g.x, g.y, coalesce(mask, 0) AS mask FROM g LEFT JOIN stitch USING (canvas, x, y) WHERE g.x < {SC} AND g.y < {SC}""",
}
