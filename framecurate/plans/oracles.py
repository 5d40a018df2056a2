"""DuckDB oracle SQL for every registered query (same column names).

Each statement re-derives its input from the driver tables independently of
the Spark adapters (e.g. export tasks straight from ``lineitem`` instead of
through JSON files), so a match checks both the adapter round trip and the
operator.
"""

from __future__ import annotations

from framecurate import testdata as td
from framecurate.functions.classes import COCO_NAMES

URL_ROOT_SQL = "/srv/ls"          # same document root as catalog.URL_ROOT

# ----------------------------------------------------------------- SQL fragments
EXPORT_CTE = f"""
li_x AS (
  SELECT *, CAST(floor(l_orderkey / {td.EXPORT_FILE_SPAN}) AS BIGINT) AS chunk,
         'exports/project-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(CAST(floor(l_orderkey / {td.EXPORT_FILE_SPAN}) AS BIGINT) AS VARCHAR) || '.json' AS file
  FROM lineitem),
tasks AS (
  SELECT file, l_orderkey AS task_id, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount,
         l_returnflag, l_linestatus,
         CAST(row_number() OVER (PARTITION BY file ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INTEGER) AS pos,
         CASE WHEN l_tax = 0 THEN NULL
              WHEN l_orderkey % 2 = 0 THEN '/data/local-files/?d=data/raw/img_' || CAST(l_partkey AS VARCHAR) || '.jpg'
              ELSE 'http://localhost:8081/data/raw/img_' || CAST(l_partkey AS VARCHAR) || '.jpg' END AS image_url,
         CASE WHEN l_tax = 0 THEN NULL ELSE 'img_' || CAST(l_partkey AS VARCHAR) || '.jpg' END AS filename,
         CASE WHEN l_tax = 0 THEN NULL ELSE '/data/raw/img_' || CAST(l_partkey AS VARCHAR) || '.jpg' END AS src_path,
         'img_' || CAST(l_partkey AS VARCHAR) AS stem,
         l_discount <> 0 AS has_ann,
         CASE WHEN l_returnflag = 'A' THEN 'salo' WHEN l_returnflag = 'N' THEN 'taro'
              WHEN l_linestatus = 'F' THEN 'cat' ELSE NULL END AS label,
         CASE WHEN l_suppkey % 29 <> 7 THEN CAST(l_partkey % 80 AS DOUBLE) + 0.5 END AS bx, CAST(l_suppkey % 70 AS DOUBLE) + 0.25 AS by_,
         l_quantity / 2 AS bw, l_quantity / 3 AS bh
  FROM li_x WHERE NOT (l_linenumber = 7 AND chunk = 0))"""

INVENTORY_CTE = """
inv AS (
  SELECT '/data/raw/img_' || CAST(p_partkey AS VARCHAR) || '.jpg' AS path,
         CASE WHEN p_brand = 'Brand#13' THEN -1 ELSE p_size * 40 + 320 END AS width,
         CASE WHEN p_brand = 'Brand#13' THEN -1 ELSE p_size * 20 + 240 END AS height
  FROM part WHERE p_size <= 45)"""

BOX_CTE = """
det AS (
  SELECT l_orderkey AS frame_id, l_linenumber - 1 AS det_idx, l_partkey, l_linenumber,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
              l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INTEGER) AS pos_idx,
         CAST(l_partkey * 37 % 2100 - 100 AS INTEGER) AS x1,
         CAST(l_suppkey * 53 % 1200 - 60 AS INTEGER) AS y1,
         CAST(l_partkey * 37 % 2100 - 100 AS INTEGER) + CAST(l_quantity AS INTEGER) * 9 - 30 AS x2,
         CAST(l_suppkey * 53 % 1200 - 60 AS INTEGER) + CAST(l_quantity AS INTEGER) * 7 - 20 AS y2,
         abs(l_discount) * 10 AS confidence,
         CAST([0, 1, 15, 99][l_linenumber % 4 + 1] AS INTEGER) AS class_id,
         l_extendedprice / 41.0 - 300.0 AS fx1, l_extendedprice / 53.0 - 200.0 AS fy1,
         l_extendedprice / 29.0 + l_quantity AS fx2, l_extendedprice / 31.0 - l_quantity AS fy2
  FROM lineitem)"""

FRAMES_CTE = """
fr AS (
  SELECT o_orderkey AS frame_id, CAST(o_custkey AS VARCHAR) AS camera_id,
         make_timestamp(epoch_us(o_orderdate) + CAST(round(o_totalprice * 1000000) AS BIGINT)) AS ts,
         CAST(coalesce(c.n, 0) AS INTEGER) AS cat_count
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_orderkey = o_orderkey)"""

COCO_CTE = "coco(class_id, name) AS (VALUES " + ", ".join(
    "({}, '{}')".format(i, n.replace("'", "''")) for i, n in enumerate(COCO_NAMES)) + ")"


def _stem_sql(ts: str, n: str, camera: str) -> str:
    return (f"{camera} || '_' || strftime({ts}, '%Y%m%d_%H%M%S_%g') || "
            f"CASE WHEN {n} > 0 THEN '_' || CAST({n} AS VARCHAR) || 'cats' ELSE '_background' END")


def _iso_sql(ts: str) -> str:
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || strftime({ts}, '%f') END")


def _pyfloat_sql(v: str) -> str:
    k = f"CAST(round(abs({v}) * 1000000) AS BIGINT)"
    sci = (f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END) || "
           f"(CASE WHEN {k} >= 10 THEN (CASE WHEN {k} % 10 = 0 THEN CAST({k} // 10 AS VARCHAR) "
           f"ELSE printf('%.1f', {k} / 10.0) END) ELSE CAST({k} AS VARCHAR) END) || "
           f"(CASE WHEN {k} >= 10 THEN 'e-05' ELSE 'e-06' END)")
    fixed = f"regexp_replace(regexp_replace(printf('%.6f', {v}), '0+$', ''), '\\.$', '.0')"
    return f"(CASE WHEN abs({v}) > 0 AND abs({v}) < 1e-4 THEN {sci} ELSE {fixed} END)"


def _name_sql(path: str) -> str:
    return f"(string_split(regexp_replace({path}, '(/+\\.?)+$', ''), '/'))[-1]"


def _norm_sql(emb: str) -> str:
    raw = f"list_transform({emb}, lambda x: abs(CAST(x AS DOUBLE)))"
    return (f"(CASE WHEN list_max({raw}) > list_min({raw}) THEN "
            f"list_transform({raw}, lambda x: (x - list_min({raw})) / (list_max({raw}) - list_min({raw}))) "
            f"ELSE list_transform({raw}, lambda x: 0.0) END)")


def _dist_sql(a: str, b: str) -> str:
    s = f"list_sum(list_transform({a}, lambda x, i: sqrt(x * {b}[i])))"
    p = f"(list_sum({a}) * list_sum({b}))"
    scale = f"(CASE WHEN abs({p}) > 1.1920928955078125e-07 THEN 1.0 / sqrt({p}) ELSE 1.0 END)"
    return f"sqrt(greatest(1.0 - {s} * {scale}, 0.0))"


YOLO_TASKS = f"""
conv AS (
  SELECT t.*, inv.path IS NOT NULL AS img_exists,
         round((bx + bw / 2) / 100, 6) AS cx, round((by_ + bh / 2) / 100, 6) AS cy,
         round(bw / 100, 6) AS w, round(bh / 100, 6) AS h,
         CASE t.label WHEN 'salo' THEN 0 WHEN 'taro' THEN 1 END AS cid
  FROM tasks t LEFT JOIN inv ON inv.path = t.src_path),
ok AS (
  SELECT *, CASE WHEN has_ann AND cid IS NOT NULL AND bx IS NOT NULL THEN 1 ELSE 0 END AS n_boxes,
         CASE WHEN has_ann AND cid IS NOT NULL AND bx IS NOT NULL THEN
           CAST(cid AS VARCHAR) || ' ' || {_pyfloat_sql('cx')} || ' ' || {_pyfloat_sql('cy')} || ' '
           || {_pyfloat_sql('w')} || ' ' || {_pyfloat_sql('h')} || chr(10) ELSE '' END AS label_text
  FROM conv WHERE image_url IS NOT NULL AND img_exists)"""

CAPTURES_CTE = f"""
cap AS (
  SELECT fr.frame_id, fr.camera_id, fr.ts, fr.cat_count,
         '/data/raw/img_' || CAST(l1.l_partkey AS VARCHAR) || '.jpg' AS full_frame
  FROM fr JOIN det l1 ON l1.frame_id = fr.frame_id AND l1.pos_idx = 0),
labeled AS (SELECT 'img_' || CAST(doc_id AS VARCHAR) || '.jpg' AS filename FROM labels),
cls AS (
  SELECT cap.*, inv.width, inv.height, {_name_sql('cap.full_frame')} AS filename,
         CASE WHEN inv.path IS NULL THEN 'error' WHEN lab.filename IS NOT NULL THEN 'skipped'
              WHEN inv.width <= 0 THEN 'error' ELSE 'exported' END AS outcome
  FROM cap LEFT JOIN inv ON inv.path = cap.full_frame
           LEFT JOIN (SELECT DISTINCT filename FROM labeled) lab ON lab.filename = {_name_sql('cap.full_frame')})"""

ROUTE_INPUT = f"""
f AS (
  SELECT CASE WHEN e.user_id % 50 <> 7 THEN CAST(e.user_id AS VARCHAR) END AS camera_id, e.event_id AS frame_id, epoch_us(e.ts) AS us,
         e.event_type <> 'view' AS has_cats,
         CASE WHEN e.event_type = 'signup' THEN 'manual_background'
              WHEN e.event_type = 'error' AND e.value > 200 THEN 'reset' END AS control,
         {_norm_sql('v.embedding')} AS h
  FROM events e JOIN embeddings v ON e.event_id % (SELECT count(*) FROM embeddings) = v.vec_id
  {{where}}),
fr_ AS (SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY us, frame_id) AS rn FROM f)"""

# full state machine: (last cat us, last cat hist, last background us) per camera
ROUTE_REC = f"""
r(camera_id, rn, frame_id, has_cats, kind, manual_save, lc, lh, lb) AS (
  SELECT camera_id, rn, frame_id, has_cats,
         CASE WHEN has_cats THEN 'cats' ELSE 'background' END,
         control = 'manual_background' AND control IS NOT NULL,
         CASE WHEN has_cats THEN us END, CASE WHEN has_cats THEN h END,
         CASE WHEN NOT has_cats OR control = 'manual_background' THEN us END
  FROM fr_ WHERE rn = 1
  UNION ALL
  SELECT s.camera_id, s.rn, s.frame_id, s.has_cats, s.kind, s.manual_save,
         CASE WHEN s.kind = 'cats' THEN s.us ELSE s.lc0 END,
         CASE WHEN s.kind = 'cats' THEN s.h ELSE s.lh0 END,
         CASE WHEN coalesce(s.control = 'manual_background', false) OR s.kind = 'background' THEN s.us ELSE s.lb0 END
  FROM (
    SELECT q.*,
      CASE WHEN q.has_cats THEN
             CASE WHEN q.lc0 IS NULL OR (q.us - q.lc0 >= {td.VF_MIN_US}::BIGINT AND
                  (q.us - q.lc0 >= {td.VF_MAX_US}::BIGINT OR {_dist_sql('q.lh0', 'q.h')} >= {td.VF_SIMILARITY}))
                  THEN 'cats' ELSE 'dropped' END
           ELSE CASE WHEN q.lb0 IS NULL OR q.us - q.lb0 >= {td.BG_INTERVAL_US}::BIGINT
                  THEN 'background' ELSE 'dropped' END END AS kind,
      coalesce(q.control = 'manual_background', false) AS manual_save
    FROM (
      SELECT fr_.camera_id, fr_.rn, fr_.frame_id, fr_.us, fr_.has_cats, fr_.control, fr_.h,
             CASE WHEN fr_.control = 'reset' THEN NULL ELSE r.lc END AS lc0,
             CASE WHEN fr_.control = 'reset' THEN NULL ELSE r.lh END AS lh0,
             CASE WHEN fr_.control = 'reset' THEN NULL ELSE r.lb END AS lb0
      FROM r JOIN fr_ ON fr_.camera_id IS NOT DISTINCT FROM r.camera_id AND fr_.rn = r.rn + 1) q) s)"""


def _route_sql(where: str, select: str) -> str:
    return ("WITH RECURSIVE " + ROUTE_INPUT.format(where=where).strip() + ",\n" + ROUTE_REC.strip()
            + "\n" + select)


def _pixels_sql(value_exprs: str) -> str:
    return (f"SELECT p_partkey AS frame_id, CAST(i % {td.THUMB} AS INTEGER) AS x, "
            f"CAST(i // {td.THUMB} AS INTEGER) AS y, p_size, {value_exprs} "
            f"FROM part, range(0, {td.THUMB * td.THUMB}) t(i)")


def _hsv_bins_sql() -> str:
    rgb = (f"CAST((p_partkey * 7 + (i % {td.THUMB}) * 5 + (i // {td.THUMB}) * 3) % 256 AS INTEGER) AS b, "
           f"CAST((p_partkey * 11 + (i % {td.THUMB}) * 2 + (i // {td.THUMB}) * 9) % 256 AS INTEGER) AS g, "
           f"CAST((p_size * 13 + (i % {td.THUMB}) * 7 + (i // {td.THUMB})) % 256 AS INTEGER) AS r")
    return f"""
px AS ({_pixels_sql(rgb)}),
mm AS (SELECT frame_id, b, g, r, greatest(b, g, r) AS v, greatest(b, g, r) - least(b, g, r) AS diff FROM px),
hs AS (
  SELECT frame_id,
    CAST(floor((diff * CASE WHEN v = 0 THEN 0 ELSE CAST(round(1044480.0 / v) AS BIGINT) END + 2048) / 4096.0) AS BIGINT) AS s,
    CAST(floor(((CASE WHEN v = r THEN g - b WHEN v = g THEN b - r + diff * 2 ELSE r - g + diff * 4 END)
       * CASE WHEN diff = 0 THEN 0 ELSE CAST(round(737280.0 / (diff * 6)) AS BIGINT) END + 2048) / 4096.0) AS BIGINT) AS h0
  FROM mm),
bins AS (SELECT frame_id, CAST(floor((CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END) * 16 / 180) AS INTEGER) AS hbin,
                CAST(floor(s * 8 / 256) AS INTEGER) AS sbin FROM hs)"""


def _lum_sql(w: int, h: int) -> str:
    """Planes of w × h, padded by reflection up to a multiple of the grid for the tiles."""
    g = td.CLAHE_GRID
    pw, ph = -(-w // g) * g, -(-h // g) * g
    tw, th = pw // g, ph // g
    clip = max(int(2.0 * tw * th / 256), 1)

    def grid(cw, ch):
        return (f"SELECT p_partkey, p_size, CAST(i % {cw} AS INTEGER) AS px, CAST(i // {cw} AS INTEGER) AS py "
                f"FROM part, range(0, {cw * ch}) t(i)")
    return f"""
pp AS (SELECT *, CASE WHEN px < {w} THEN px ELSE {2 * (w - 1)} - px END AS x,
              CASE WHEN py < {h} THEN py ELSE {2 * (h - 1)} - py END AS y FROM ({grid(pw, ph)})),
th AS (SELECT p_partkey AS frame_id, CAST(py // {th} AS INTEGER) AS ty, CAST(px // {tw} AS INTEGER) AS tx,
              CAST((p_partkey * 3 + x * y + p_size * x) % 256 AS INTEGER) AS l, count(*) AS n FROM pp GROUP BY ALL),
tiles AS (SELECT frame_id, ty, tx, map_from_entries(list((l, n))) AS m FROM th GROUP BY ALL),
dense AS (SELECT frame_id, ty, tx, list_transform(range(0, 256), lambda b: coalesce(m[CAST(b AS INTEGER)], 0)) AS h FROM tiles),
ex AS (SELECT *, CAST(list_sum(list_transform(h, lambda n: greatest(n - {clip}, 0))) AS BIGINT) AS e FROM dense),
cl AS (
  SELECT frame_id, ty, tx, list_transform(h, lambda n, i: least(n, {clip}) + e // 256
    + CASE WHEN e % 256 > 0 AND (i - 1) % greatest(256 // greatest(e % 256, 1), 1) = 0
                AND (i - 1) // greatest(256 // greatest(e % 256, 1), 1) < e % 256 THEN 1 ELSE 0 END) AS c FROM ex),
lut AS (
  SELECT frame_id, ty, tx, list_transform(c, lambda n, i:
    CAST(least(round_even(CAST(list_sum(c[1:i]) AS FLOAT) * CAST({255 / (tw * th)} AS FLOAT), 0), 255) AS INTEGER)) AS lut
  FROM cl)"""


def _equalized_sql(w: int, h: int) -> str:
    g = td.CLAHE_GRID
    tw, th = -(-w // g), -(-h // g)

    def place(c, size):
        f = f"(CAST({c} AS FLOAT) * CAST({1.0 / size} AS FLOAT) - CAST(0.5 AS FLOAT))"
        low = f"CAST(floor({f}) AS INTEGER)"
        return f"CAST({f} - CAST(floor({f}) AS FLOAT) AS FLOAT)", f"greatest({low}, 0)", f"least({low} + 1, {g - 1})"
    xa, ta, tb = place("x", tw)
    ya, ua, ub = place("y", th)
    value = "CAST((p_partkey * 3 + x * y + p_size * x) % 256 AS INTEGER)"
    at = lambda u, t: f"CAST(f[({u} * {g} + {t}) * 256 + {value} + 1] AS FLOAT)"
    one = "CAST(1 AS FLOAT)"
    return "WITH " + _lum_sql(w, h).strip() + f""",
flat AS (SELECT frame_id, flatten(list(lut ORDER BY ty, tx)) AS f FROM lut GROUP BY frame_id),
lines AS (SELECT p_partkey, p_size, f, CAST(yy AS INTEGER) AS y FROM flat JOIN part ON p_partkey = frame_id, range(0, {h}) t(yy)),
placed AS (SELECT *, {ya} AS ya, {ua} AS ua, {ub} AS ub FROM lines)
SELECT p_partkey AS frame_id, y, array_to_string(list_transform(range(0, {w}), lambda x:
  CAST(least(greatest(round_even(CAST(
    ({at('ua', ta)} * ({one} - {xa}) + {at('ua', tb)} * {xa}) * ({one} - ya)
    + ({at('ub', ta)} * ({one} - {xa}) + {at('ub', tb)} * {xa}) * ya AS FLOAT), 0), 0), 255) AS INTEGER)), ',') AS l_eq
FROM placed"""


def _lab_sql() -> str:
    lin = lambda c: f"CASE WHEN {c} / 255.0::DOUBLE <= 0.04045 THEN {c} / 255.0::DOUBLE / 12.92 ELSE pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"
    f = lambda t: f"CASE WHEN {t} > 0.008856 THEN pow({t}, 1.0::DOUBLE / 3.0) ELSE 7.787 * {t} + 16.0::DOUBLE / 116.0 END"
    inv = lambda t: f"CASE WHEN {t} > 0.206893 THEN pow({t}, 3.0) ELSE ({t} - 16.0::DOUBLE / 116.0) / 7.787 END"
    clamp = lambda v: f"CAST(least(greatest(round({v}), 0), 255) AS INTEGER)"
    to8 = lambda v: clamp(f"(CASE WHEN {v} <= 0.0031308 THEN 12.92 * {v} ELSE 1.055 * pow(greatest({v}, 0), 1.0::DOUBLE / 2.4) - 0.055 END) * 255.0")
    return f"""
WITH px AS (SELECT DISTINCT CAST(l_partkey * 7 % 256 AS INTEGER) AS b, CAST(l_suppkey * 29 % 256 AS INTEGER) AS g,
                            CAST(l_orderkey % 256 AS INTEGER) AS r FROM lineitem),
lin AS (SELECT *, {lin('b')} AS bl, {lin('g')} AS gl, {lin('r')} AS rl FROM px),
xyz AS (SELECT *, (0.412453::DOUBLE * rl + 0.357580::DOUBLE * gl + 0.180423::DOUBLE * bl) / 0.950456::DOUBLE AS x,
  0.212671::DOUBLE * rl + 0.715160::DOUBLE * gl + 0.072169::DOUBLE * bl AS y,
  (0.019334::DOUBLE * rl + 0.119193::DOUBLE * gl + 0.950227::DOUBLE * bl) / 1.088754::DOUBLE AS z FROM lin),
fs AS (SELECT *, {f('x')} AS fx, {f('y')} AS fy, {f('z')} AS fz FROM xyz),
lab AS (SELECT b, g, r, {clamp("(CASE WHEN y > 0.008856 THEN 116.0 * fy - 16.0 ELSE 903.3 * y END) * 255.0 / 100.0")} AS lab_l,
  {clamp("500.0 * (fx - fy) + 128.0")} AS lab_a, {clamp("200.0 * (fy - fz) + 128.0")} AS lab_b FROM fs),
back AS (SELECT *, (lab_l * 100.0::DOUBLE / 255.0 + 16.0) / 116.0 AS f2 FROM lab),
inv AS (SELECT *, f2 + (lab_a - 128.0::DOUBLE) / 500.0 AS f1, f2 - (lab_b - 128.0::DOUBLE) / 200.0 AS f3 FROM back),
xyz2 AS (SELECT *, ({inv('f1')}) * 0.950456::DOUBLE AS x, {inv('f2')} AS y, ({inv('f3')}) * 1.088754::DOUBLE AS z FROM inv),
rgb AS (SELECT *, 3.240479::DOUBLE * x - 1.53715::DOUBLE * y - 0.498535::DOUBLE * z AS rl,
  -0.969256::DOUBLE * x + 1.875991::DOUBLE * y + 0.041556::DOUBLE * z AS gl,
  0.055648::DOUBLE * x - 0.204043::DOUBLE * y + 1.057311::DOUBLE * z AS bl FROM xyz2)
SELECT b, g, r, lab_l, lab_a, lab_b, {to8('bl')} AS b2, {to8('gl')} AS g2, {to8('rl')} AS r2 FROM rgb"""


def _lab_fixed_sql() -> str:
    """The fixed-point form with each table value computed where it is used."""
    root, white, one = 1 << 15, 255 << 5, 1 << 20
    up = lambda v: f"CAST(floor(({v}) + 0.5) AS BIGINT)"
    k = lambda v, scale: int(v * scale + (0.5 if v >= 0 else -0.5))
    light = lambda c: up(f"(CASE WHEN {c} / 255.0::DOUBLE <= 0.04045 THEN {c} / 255.0::DOUBLE / 12.92 ELSE pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END) * {white}")
    f = lambda t: up(f"(CASE WHEN {t} / {white}.0::DOUBLE > 0.008856 THEN pow({t} / {white}.0::DOUBLE, 1.0::DOUBLE / 3.0) ELSE 7.787 * ({t} / {white}.0::DOUBLE) + 16.0::DOUBLE / 116.0 END) * {root}")
    xyz = lambda w, s: f"(rl * {k(w[0] / s, 4096)} + gl * {k(w[1] / s, 4096)} + bl * {k(w[2] / s, 4096)} + 2048) >> 12"
    byte = lambda v: f"CAST(least(greatest({v}, 0), 255) AS INTEGER)"
    down = lambda v, by: f"CAST(floor(({v})::DOUBLE / {by}) AS BIGINT)"
    cube = lambda t: f"CASE WHEN {t} > {k(0.206893, one)} THEN {down(f'{down(f'{t} * {t}', one)} * {t}', one)} ELSE {down(f'({t} - {k(16 / 116, one)}) * {k(1 / 7.787, one)}', one)} END"

    def channel(w):
        m = [k(c * s, one) for c, s in zip(w, (0.950456, 1.0, 1.088754))]
        at = down(f"{down(f'x * {m[0]} + y * {m[1]} + z * {m[2]}', one)} * {white} + {one // 2}", one)
        v = f"(least(greatest({at}, 0), {white}) / {white}.0::DOUBLE)"
        return f"CAST({up(f'(CASE WHEN {v} <= 0.0031308 THEN 12.92 * {v} ELSE 1.055 * pow({v}, 1.0::DOUBLE / 2.4) - 0.055 END) * 255')} AS INTEGER)"

    return f"""
WITH px AS (SELECT DISTINCT CAST(l_partkey * 7 % 256 AS INTEGER) AS b, CAST(l_suppkey * 29 % 256 AS INTEGER) AS g,
                            CAST(l_orderkey % 256 AS INTEGER) AS r FROM lineitem),
lin AS (SELECT *, {light('b')} AS bl, {light('g')} AS gl, {light('r')} AS rl FROM px),
xyz AS (SELECT *, {xyz((0.412453, 0.357580, 0.180423), 0.950456)} AS x,
  {xyz((0.212671, 0.715160, 0.072169), 1.0)} AS y, {xyz((0.019334, 0.119193, 0.950227), 1.088754)} AS z FROM lin),
fs AS (SELECT *, {f('x')} AS fx, {f('y')} AS fy, {f('z')} AS fz FROM xyz),
lab AS (SELECT b, g, r, {byte(f"(fy * 2958 - {403 * root}) // {10 * root}")} AS lab_l,
  {byte(down(f"(fx - fy) * 500 + {128 * root + root // 2}", root))} AS lab_a,
  {byte(down(f"(fy - fz) * 200 + {128 * root + root // 2}", root))} AS lab_b FROM fs),
back AS (SELECT *, {up(f"(lab_l * 100.0::DOUBLE / 255.0 + 16.0) / 116.0 * {one}")} AS f2 FROM lab),
inv AS (SELECT *, f2 + {up(f"(lab_a - 128) / 500.0::DOUBLE * {one}")} AS f1,
  f2 - {up(f"(lab_b - 128) / 200.0::DOUBLE * {one}")} AS f3 FROM back),
xyz2 AS (SELECT b, g, r, lab_l, lab_a, lab_b, {cube('f1')} AS x, {cube('f2')} AS y, {cube('f3')} AS z FROM inv)
SELECT b, g, r, lab_l, lab_a, lab_b, {channel((0.055648, -0.204043, 1.057311))} AS b2,
  {channel((-0.969256, 1.875991, 0.041556))} AS g2, {channel((3.240479, -1.537150, -0.498535))} AS r2 FROM xyz2"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    E = "WITH " + EXPORT_CTE.strip()
    q["export_tasks_parse"] = E + "\nSELECT file, pos, task_id, image_url, filename FROM tasks"
    q["merge_dedup_first"] = E + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY file, pos) AS rn FROM tasks WHERE filename IS NOT NULL)
SELECT filename, file, pos, image_url, task_id FROM ranked WHERE rn = 1"""
    q["merge_stats"] = E + """
SELECT (SELECT count(DISTINCT file) FROM li_x) AS files, (SELECT count(*) FROM tasks) AS total,
       (SELECT count(filename) - count(DISTINCT filename) FROM tasks) AS duplicates,
       (SELECT count(DISTINCT filename) FROM tasks) AS unique_tasks"""
    q["tasks_per_file"] = E + """
SELECT file, count(*) FILTER (WHERE NOT (l_linenumber = 7 AND chunk = 0)) AS n_tasks FROM li_x GROUP BY file"""
    q["distinct_filenames"] = E + "\nSELECT DISTINCT filename FROM tasks WHERE filename IS NOT NULL"
    q["export_union"] = E + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY file, pos) AS rn FROM tasks WHERE filename IS NOT NULL)
SELECT 'export' AS source, filename, file, pos FROM tasks
UNION ALL SELECT 'merged' AS source, filename, file, pos FROM ranked WHERE rn = 1"""
    q["percent_to_yolo"] = E + """
SELECT file, pos, 0 AS box_idx, round((bx + bw / 2) / 100, 6) AS cx, round((by_ + bh / 2) / 100, 6) AS cy,
       round(bw / 100, 6) AS w, round(bh / 100, 6) AS h FROM tasks WHERE has_ann"""
    q["label_class_id"] = E + """
SELECT file, pos, 0 AS box_idx, label, CASE label WHEN 'salo' THEN 0 WHEN 'taro' THEN 1 END AS class_id
FROM tasks WHERE has_ann
UNION ALL SELECT file, pos, 1, 'salo', 0 FROM tasks WHERE has_ann AND l_quantity > 40"""
    q["convert_unwrap"] = E + """
SELECT file, pos, image_url FROM tasks WHERE l_linenumber <> 6
UNION ALL SELECT DISTINCT file, 0, CAST(NULL AS VARCHAR) FROM tasks WHERE l_linenumber = 6"""
    q["first_annotation"] = E + """
SELECT file, pos, has_ann AS has_annotations,
       CASE WHEN NOT has_ann THEN 0 WHEN l_quantity > 40 THEN 2 ELSE 1 END AS n_results,
       CASE WHEN has_ann THEN 1 ELSE 0 END AS n_rect FROM tasks"""
    EI = E + "," + INVENTORY_CTE
    q["image_exists_semi"] = EI + "\nSELECT file, pos, src_path AS path FROM tasks WHERE src_path IN (SELECT path FROM inv)"
    q["image_missing_anti"] = EI + "\nSELECT file, pos, src_path AS path FROM tasks WHERE src_path IS NOT NULL AND src_path NOT IN (SELECT path FROM inv)"
    EY = EI + "," + YOLO_TASKS
    q["yolo_label_text"] = EY + "\nSELECT file, pos, stem, n_boxes, label_text FROM ok"
    q["label_dedup_last"] = EY + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY file DESC, pos DESC) AS rn FROM ok)
SELECT stem, file, pos, stem || '.jpg' AS image_name, label_text, n_boxes FROM ranked WHERE rn = 1"""
    q["labeled_images"] = EY + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY src_path ORDER BY file DESC, pos DESC) AS rn FROM ok)
SELECT stem, stem || '.jpg' AS image_name, src_path AS image_path FROM ranked WHERE rn = 1"""
    q["convert_summary"] = EY + """
SELECT count(*) AS tasks, CAST(coalesce(sum(CASE WHEN ok.file IS NOT NULL THEN ok.n_boxes ELSE 0 END), 0) AS BIGINT) AS boxes,
       count(*) FILTER (WHERE coalesce(ok.n_boxes, 0) = 0) AS background_count
FROM conv LEFT JOIN ok ON ok.file = conv.file AND ok.pos = conv.pos"""
    q["class_box_counts"] = EY + """
SELECT c.class_id, c.class_name,
       CAST(coalesce(sum(CASE WHEN ok.label = c.class_name THEN 1 ELSE 0 END
                      + CASE WHEN c.class_name = 'salo' AND ok.l_quantity > 40 THEN 1 ELSE 0 END), 0) AS BIGINT) AS boxes
FROM (VALUES (0, 'salo'), (1, 'taro')) c(class_id, class_name)
LEFT JOIN ok ON ok.n_boxes > 0
GROUP BY c.class_id, c.class_name"""
    q["convert_warnings"] = EY + """
SELECT 'convert' AS stage, file, pos, -1 AS seq, 'Task has no image URL, skipping' AS reason FROM conv WHERE image_url IS NULL
UNION ALL
SELECT 'convert', file, pos, -1, 'Image not found: ' || src_path FROM conv WHERE image_url IS NOT NULL AND NOT img_exists
UNION ALL
SELECT 'convert', file, pos, 0,
       CASE WHEN label IS NULL THEN stem || ': box with no label, skipping'
            WHEN cid IS NULL THEN stem || ': unknown label ''' || label || ''', skipping'
            ELSE stem || ': box without coordinates, skipping' END
FROM ok WHERE has_ann AND (cid IS NULL OR bx IS NULL)"""

    B = "WITH " + BOX_CTE.strip()
    q["box_area"] = B + "\nSELECT frame_id, det_idx, CAST(greatest(x2 - x1, 0) AS BIGINT) * CAST(greatest(y2 - y1, 0) AS BIGINT) AS area FROM det"
    q["box_center"] = B + "\nSELECT frame_id, det_idx, CAST(floor((x1 + x2) / 2) AS BIGINT) AS cx, CAST(floor((y1 + y2) / 2) AS BIGINT) AS cy FROM det"
    q["int_box"] = B + """
SELECT frame_id, det_idx, CAST(trunc(fx1) AS INTEGER) AS x1, CAST(trunc(fy1) AS INTEGER) AS y1,
       CAST(trunc(fx2) AS INTEGER) AS x2, CAST(trunc(fy2) AS INTEGER) AS y2 FROM det"""
    q["round_confidence"] = "SELECT l_orderkey AS frame_id, l_linenumber - 1 AS det_idx, round(l_extendedprice / 104999.0, 4) AS confidence FROM lineitem"
    q["clamp_box"] = B + f"""
SELECT frame_id, det_idx, greatest(0, x1) AS x1, greatest(0, y1) AS y1, least({td.FRAME_W}, x2) AS x2,
       least({td.FRAME_H}, y2) AS y2 FROM det"""
    q["box_to_percent"] = B + f"""
SELECT frame_id, det_idx, CAST(x1 AS DOUBLE) / {td.FRAME_W}.0 * 100 AS x, CAST(y1 AS DOUBLE) / {td.FRAME_H}.0 * 100 AS y,
       CAST(x2 - x1 AS DOUBLE) / {td.FRAME_W}.0 * 100 AS width, CAST(y2 - y1 AS DOUBLE) / {td.FRAME_H}.0 * 100 AS height FROM det"""
    q["class_label_lookup"] = B + """
SELECT frame_id, det_idx, class_id, CASE class_id WHEN 0 THEN 'salo' WHEN 1 THEN 'taro' ELSE 'cat' END AS label FROM det"""
    q["class_name_fallback"] = B + ", " + COCO_CTE + """
SELECT frame_id, det_idx, det.class_id, coalesce(coco.name, 'class_' || CAST(det.class_id AS VARCHAR)) AS name
FROM det LEFT JOIN coco ON coco.class_id = det.class_id"""

    F_ = "WITH " + FRAMES_CTE.strip()
    q["frame_cat_count"] = F_ + "\nSELECT frame_id, cat_count, cat_count > 0 AS has_cats FROM fr"
    q["capture_stem"] = F_ + f"\nSELECT frame_id, {_stem_sql('ts', 'cat_count', 'camera_id')} AS stem FROM fr"
    q["iso_timestamp"] = F_ + f"\nSELECT frame_id, {_iso_sql('ts')} AS iso FROM fr"
    FB = F_ + ", " + BOX_CTE.strip()
    q["crop_eligible"] = FB + f"""
SELECT det.frame_id, det.pos_idx AS det_idx, {_stem_sql('fr.ts', 'fr.cat_count', 'fr.camera_id')} || '_crop_' || CAST(det.pos_idx AS VARCHAR) AS crop_name
FROM det JOIN fr ON fr.frame_id = det.frame_id
WHERE least({td.FRAME_W}, x2) - greatest(0, x1) >= 32 AND least({td.FRAME_H}, y2) - greatest(0, y1) >= 32"""
    q["overlay_rows"] = B + ", " + COCO_CTE + """
SELECT frame_id, pos_idx AS det_idx, x1, y1, x2, y2,
       CASE det.class_id WHEN 0 THEN 0 WHEN 1 THEN 255 WHEN 15 THEN 0 ELSE 0 END AS color_b,
       CASE det.class_id WHEN 0 THEN 165 WHEN 1 THEN 255 WHEN 15 THEN 255 ELSE 255 END AS color_g,
       CASE det.class_id WHEN 0 THEN 255 WHEN 1 THEN 0 WHEN 15 THEN 0 ELSE 255 END AS color_r,
       coalesce(coco.name, 'class_' || CAST(det.class_id AS VARCHAR)) AS name,
       round(confidence, 2) AS conf2,
       coalesce(coco.name, 'class_' || CAST(det.class_id AS VARCHAR)) || ' ' || printf('%.2f', round(confidence, 2)) AS caption,
       x1 AS text_x, y1 - 8 AS text_y
FROM det LEFT JOIN coco ON coco.class_id = det.class_id"""
    q["confidence_filter"] = B + "\nSELECT frame_id, pos_idx AS det_idx, confidence FROM det WHERE confidence >= 0.4"
    q["class_scope_filter"] = B + "\nSELECT frame_id, pos_idx AS det_idx, class_id FROM det WHERE class_id = 15"
    q["class_scope_other"] = B + "\nSELECT frame_id, pos_idx AS det_idx, class_id FROM det"
    q["debug_summary"] = B + ", " + COCO_CTE + """,
best AS (SELECT frame_id, coalesce(coco.name, 'class_' || CAST(det.class_id AS VARCHAR)) AS name, max(confidence) AS c
  FROM det LEFT JOIN coco ON coco.class_id = det.class_id WHERE confidence >= 0.1 GROUP BY ALL)
SELECT frame_id, string_agg(name || ': ' || printf('%.2f', c), ', ' ORDER BY c DESC, name) AS summary FROM best GROUP BY 1"""
    q["detections_ranked"] = B + """
SELECT frame_id, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY confidence DESC, pos_idx) AS INTEGER) AS rank,
       pos_idx AS det_idx, confidence FROM det"""
    q["best_confidence_per_class"] = B + ", " + COCO_CTE + """
SELECT frame_id, coalesce(coco.name, 'class_' || CAST(det.class_id AS VARCHAR)) AS name, max(confidence) AS best_confidence
FROM det LEFT JOIN coco ON coco.class_id = det.class_id WHERE confidence >= 0.1 GROUP BY ALL"""

    CAP = F_ + "," + INVENTORY_CTE + ", " + BOX_CTE.strip() + "," + CAPTURES_CTE
    q["export_outcomes"] = CAP + "\nSELECT frame_id, full_frame, outcome FROM cls"
    q["export_summary"] = CAP + """
SELECT count(*) FILTER (WHERE outcome = 'exported') AS exported, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
       count(*) FILTER (WHERE outcome = 'error') AS errors FROM cls"""
    q["annotation_task_json"] = CAP + """
SELECT cls.frame_id, '/data/local-files/?d=' || substr(cls.full_frame, 7) AS image_url, cls.cat_count AS n_results,
       CASE WHEN cls.cat_count > 0 THEN first(CASE d.class_id WHEN 0 THEN 'salo' WHEN 1 THEN 'taro' ELSE 'cat' END
                                               ORDER BY d.pos_idx) OVER (PARTITION BY cls.frame_id) END AS first_label,
       d.pos_idx AS box_idx,
       CAST(d.x1 AS DOUBLE) / cls.width * 100 AS x, CAST(d.y1 AS DOUBLE) / cls.height * 100 AS y,
       CAST(d.x2 - d.x1 AS DOUBLE) / cls.width * 100 AS width, CAST(d.y2 - d.y1 AS DOUBLE) / cls.height * 100 AS height,
       CASE d.class_id WHEN 0 THEN 'salo' WHEN 1 THEN 'taro' ELSE 'cat' END AS label,
       cls.width AS original_width, cls.height AS original_height
FROM cls JOIN det d ON d.frame_id = cls.frame_id WHERE cls.outcome = 'exported'"""
    q["capture_meta_parse"] = CAP + f"""
SELECT cap.frame_id, {_iso_sql('cap.ts')} AS timestamp, cap.cat_count, cap.full_frame,
       CAST((SELECT count(*) FROM det d WHERE d.frame_id = cap.frame_id
              AND least({td.FRAME_W}, d.x2) - greatest(0, d.x1) >= 32 AND least({td.FRAME_H}, d.y2) - greatest(0, d.y1) >= 32) AS INTEGER) AS n_crops,
       cap.cat_count AS n_dets,
       (SELECT round(d.confidence, 4) FROM det d WHERE d.frame_id = cap.frame_id AND d.pos_idx = 0) AS first_conf,
       (SELECT d.x2 FROM det d WHERE d.frame_id = cap.frame_id AND d.pos_idx = 0) AS first_x2
FROM cap"""

    q["image_dims"] = "WITH " + INVENTORY_CTE.strip() + "\nSELECT path, width, height, width > 0 AS readable FROM inv"
    q["image_url_build"] = "WITH " + INVENTORY_CTE.strip() + """
SELECT path, CASE WHEN starts_with(path, '/data/') THEN '/data/local-files/?d=' || substr(path, 7) END AS local_url,
       CASE WHEN starts_with(path, '/data/') THEN 'http://localhost:8081/' || substr(path, 7) END AS http_url FROM inv"""

    pages = """WITH pu AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/data/local-files/?d=' || regexp_replace(url, '^https?://[^/]+/', '') || CASE WHEN page_id % 10 = 4 THEN '/100%/a%2.jpg' ELSE '' END ELSE url END AS url FROM pages)"""
    tail = "CASE WHEN strpos(url, '?d=') > 0 THEN (string_split(url, '?d='))[-1] ELSE url END"
    q["image_filename"] = pages + f"""
SELECT page_id, url, CASE WHEN url IS NULL OR url = '' THEN NULL ELSE {_name_sql(tail)} END AS filename FROM pu"""
    q["image_path"] = pages + f""",
a AS (SELECT page_id, url, regexp_replace(url, '#.*$', '') AS nf FROM pu),
b AS (SELECT *, regexp_extract(regexp_extract(nf, '^[^?]*\\?(.*)$', 1), '(?:^|&)d=([^&]+)', 1) AS d_raw,
             regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nf,
               '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//[^/?]*', ''), '\\?.*$', ''), ';[^/]*$', ''), '^/+', '') AS http_rel
      FROM a),
c AS (SELECT page_id, url, CASE WHEN strpos(url, '/data/local-files/') > 0 THEN url_decode(replace(d_raw, '+', ' ')) ELSE http_rel END AS rel FROM b),
d AS (SELECT page_id, url, CASE WHEN starts_with(rel, '/') THEN rel ELSE '{URL_ROOT_SQL}/' || rel END AS j FROM c),
e AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(j, '/{{2,}}', '/', 'g'),
        '/(\\./)+', '/', 'g'), '^(\\./)+', ''), '(.)/\\.?$', '\\1') AS s FROM d)
SELECT page_id, url, CASE WHEN s = '' OR s = '.' THEN '.' ELSE s END AS path FROM e"""
    q["file_stem"] = f"""
SELECT page_id, regexp_replace({_name_sql('url')}, '^(.+)\\.[^.]+$', '\\1') AS stem FROM pages"""

    q["unlabeled_queue"] = """
SELECT doc_id, 'img_' || CAST(doc_id AS VARCHAR) || '.jpg' AS filename FROM documents
WHERE 'img_' || CAST(doc_id AS VARCHAR) || '.jpg' NOT IN (SELECT 'img_' || CAST(doc_id AS VARCHAR) || '.jpg' FROM labels)"""
    listing = """WITH img AS (SELECT '/data/labeled/images/img_' || CAST(p_partkey AS VARCHAR)
                  || CASE WHEN p_size % 10 = 0 THEN '.JPG' WHEN p_size % 10 = 1 THEN '.png' ELSE '.jpg' END AS path FROM part),
lab AS (SELECT DISTINCT '/data/labeled/labels/img_' || CAST(l_partkey AS VARCHAR) || '.txt' AS label_path,
               'img_' || CAST(l_partkey AS VARCHAR) AS stem FROM lineitem WHERE l_returnflag = 'N'),
s AS (SELECT regexp_replace(""" + _name_sql("path") + """, '^(.+)\\.[^.]+$', '\\1') AS stem, path AS image_path
      FROM img WHERE ends_with(path, '.jpg'))"""
    q["sample_inventory"] = listing + "\nSELECT stem, image_path FROM s"
    q["pair_samples"] = listing + "\nSELECT s.stem, s.image_path, lab.label_path FROM s JOIN lab ON lab.stem = s.stem"

    split = """WITH d AS (SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS stem FROM documents),
k AS (SELECT stem, row_number() OVER (ORDER BY md5('42:' || stem), stem) - 1 AS rn, count(*) OVER () AS n FROM d),
sp AS (SELECT stem, CASE WHEN rn < floor(n * 0.8::DOUBLE) THEN 'train'
                         WHEN rn < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM k)"""
    q["seeded_split"] = split + "\nSELECT stem, split FROM sp"
    q["split_counts"] = split + "\nSELECT split, count(*) AS n FROM sp GROUP BY split"
    man = """
SELECT '{path}' AS path, 'train/images' AS train, 'val/images' AS val, 'test/images' AS test, 2 AS nc,
       '["salo","taro"]' AS names_json,
       count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val,
       count(*) FILTER (WHERE split = 'test') AS n_test FROM sp"""
    q["split_manifest"] = split + man.format(path="/data/labeled")
    q["manifest_relocate"] = split + man.format(path="/content/dataset")

    q["minmax_normalize"] = f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, h[i] AS v
FROM (SELECT vec_id, {_norm_sql('embedding')} AS h FROM embeddings), range(1, 65) t(i)"""
    q["bhattacharyya_consecutive"] = f"""
WITH n AS (SELECT vec_id, {_norm_sql('embedding')} AS h FROM embeddings)
SELECT a.vec_id, b.vec_id AS next_id, {_dist_sql('a.h', 'b.h')} AS distance FROM n a JOIN n b ON b.vec_id = a.vec_id + 1"""
    q["hs_histogram"] = "WITH " + _hsv_bins_sql().strip() + "\nSELECT frame_id, hbin, sbin, count(*) AS n FROM bins GROUP BY ALL"
    lum = "WITH " + _lum_sql(td.THUMB, td.THUMB).strip()
    q["tile_histogram"] = lum + """
SELECT frame_id, ty, tx, string_agg(l || ':' || n, ',' ORDER BY l) AS counts FROM th GROUP BY ALL"""
    q["clipped_histogram"] = lum + """
SELECT frame_id, ty, tx, array_to_string(c, ',') AS counts FROM cl"""
    q["equalize_lut"] = lum + """
SELECT frame_id, ty, tx, array_to_string(lut, ',') AS lut FROM lut"""
    q["equalize_apply"] = _equalized_sql(td.THUMB, td.THUMB)
    q["equalize_apply_padded"] = _equalized_sql(td.ODD_W, td.ODD_H)
    q["lab_round_trip"] = _lab_sql()
    q["lab_fixed"] = _lab_fixed_sql()
    q["unlabeled_queue_bucketed"] = q["unlabeled_queue"]
    q["export_outcomes_bucketed"] = q["export_outcomes"]
    q["export_large_files"] = q["export_tasks_parse"]
    q["merge_runs"] = q["merge_dedup_first"]
    q["merged_task_shards"] = q["merge_dedup_first"].replace("SELECT filename, file, pos, image_url, task_id", "SELECT filename, image_url, task_id")
    q["import_task_shards"] = CAP + """
SELECT '/data/local-files/?d=' || substr(full_frame, 7) AS image_url, cat_count AS n_results FROM cls WHERE outcome = 'exported'"""
    q["split_table"] = q["seeded_split"]
    q["queue_stream"] = q["unlabeled_queue"]
    q["crop_pixels"] = """
WITH d AS (SELECT doc_id AS frame_id, hex(encode(text)) AS h, octet_length(encode(text)) // 16 AS rows, doc_id % 5 AS x1 FROM documents),
r AS (SELECT frame_id, string_agg(substr(h, CAST((y * 16 + x1) * 2 + 1 AS BIGINT), 14), '' ORDER BY y) AS c
      FROM d, range(0, 9) t(y) WHERE y >= 1 AND y < least(rows, 9) GROUP BY frame_id)
SELECT frame_id, lower(c) AS crop_hex FROM d LEFT JOIN r USING (frame_id)"""

    q["route_frames_waves"] = _route_sql("", "SELECT camera_id, frame_id, kind, manual_save FROM r")
    q["route_frames_stream"] = q["route_frames_waves"]
    q["route_frames"] = _route_sql("", "SELECT camera_id, frame_id, kind, manual_save FROM r")
    q["session_stats"] = _route_sql("", """SELECT camera_id, count(*) AS total_frames, count(*) FILTER (WHERE has_cats) AS detection_frames,
       count(*) FILTER (WHERE kind = 'cats') AS saved_frames, count(*) FILTER (WHERE kind = 'background') AS background_frames
FROM r GROUP BY camera_id""")
    q["variety_filter"] = _route_sql("WHERE e.event_type <> 'view'", "SELECT camera_id, frame_id, kind = 'cats' AS kept FROM r") \
        .replace("e.value > 200 THEN 'reset'", "false THEN 'reset'").replace("e.event_type = 'signup' THEN 'manual_background'", "false THEN 'manual_background'")
    q["background_throttle"] = _route_sql("WHERE e.event_type = 'view'", "SELECT camera_id, frame_id, kind = 'background' AS kept FROM r") \
        .replace("e.value > 200 THEN 'reset'", "false THEN 'reset'").replace("e.event_type = 'signup' THEN 'manual_background'", "false THEN 'manual_background'")
    q["background_throttle_manual"] = _route_sql("", """SELECT camera_id, frame_id, CASE WHEN NOT has_cats THEN kind END AS bg_kind, manual_save
FROM r WHERE NOT has_cats OR manual_save""")
    q["background_throttle_jumps"] = q["background_throttle_manual"]
    q["latest_frame"] = """
WITH f AS (SELECT CASE WHEN user_id % 50 <> 7 THEN CAST(user_id AS VARCHAR) END AS camera_id, event_id AS frame_id, ts, date_trunc('day', ts) AS bucket FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY camera_id, bucket ORDER BY ts DESC, frame_id DESC) AS rn FROM f)
SELECT camera_id, bucket, frame_id, ts FROM k WHERE rn = 1"""
    return q
