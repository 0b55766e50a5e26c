"""The registered queries in plain SQL, for comparison with another engine.

Written from the meaning of each query (brute-force joins, hex strings instead of
bytes) and sharing only the expressions that derive the inputs.
"""

from __future__ import annotations

from markfield.config import TRANSFORMS
from markfield.plans import standins as S


def _shared(expressions: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f'{text} AS "{name}"' for name, text in expressions.items()) + f" FROM {table}"


TOKEN = "(?i)(^|[^A-Za-z]){}([^A-Za-z]|$)"
LAST = "(?i)^(?:.*[^A-Za-z])?(BPD|TED|TSD)((?:[^A-Za-z].*)?)$"
HAS = {name: f"regexp_matches(stem, '{TOKEN.format(name)}')" for name in ("BPD", "TED", "TSD")}


def _stage(text: str) -> str:
    before = f"regexp_matches(lower({text}), '(^|[^a-z])before([^a-z]|$)')"
    after = f"regexp_matches(lower({text}), '(^|[^a-z])after([^a-z]|$)')"
    return f"CASE WHEN {before} AND NOT {after} THEN 'before' WHEN {after} AND NOT {before} THEN 'after' END"


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ names and files
CTES["raw_files"] = _shared(S.ANNOTATION_FILES, "orders")
CTES["split_files"] = """
  SELECT *, regexp_extract(relpath, '([^/]*)\\.roi$', 1) AS stem,
         regexp_extract(relpath, '^(.*)/[^/]*$', 1) AS parent,
         split_part(relpath, '/', 1) AS top_folder
  FROM raw_files"""
CTES["labels0"] = f"""
  SELECT *, CAST({HAS['BPD']} AS INT) + CAST({HAS['TED']} AS INT) + CAST({HAS['TSD']} AS INT) AS classes,
         upper(regexp_extract(stem, '{LAST}', 1)) AS last_class,
         lower(regexp_extract(regexp_extract(stem, '{LAST}', 2), '^\\s*\\(\\s*([A-Za-z])\\s*\\)', 1)) AS last_letter
  FROM split_files"""
CTES["named"] = f"""
  SELECT *, CASE WHEN classes = 1 THEN last_class END AS label,
         CASE WHEN classes = 1 THEN nullif(last_letter, '') END AS subtype,
         CASE WHEN classes = 0 THEN 'unknown_label' WHEN classes > 1 THEN 'multiple_class_names'
              WHEN last_class = 'BPD' AND last_letter <> '' THEN 'unexpected_subtype'
              WHEN last_class = 'BPD' THEN NULL
              WHEN last_letter = '' THEN 'missing_subtype'
              WHEN last_class = 'TED' AND last_letter NOT IN ('a','b','c','d','e','f') THEN 'invalid_subtype'
              WHEN last_class = 'TSD' AND last_letter NOT IN ('a','b','c') THEN 'invalid_subtype' END AS problem,
         nullif(regexp_extract(top_folder, '^(\\d+) Area$', 1), '') AS area,
         coalesce({_stage('stem')}, {_stage('parent')}) AS stage,
         lower(split_part(parent, '/', 3)) = 'roiset' AS in_set,
         split_part(parent, '/', 1) || '/' || split_part(parent, '/', 2) AS directory
  FROM labels0"""
CTES["hints0"] = r"""
  SELECT *, regexp_extract_all(CASE WHEN area IS NULL THEN prefix ELSE regexp_replace(prefix, '(?i)area\s*\d+', '', 'g') END, '\d+') AS runs
  FROM (SELECT *, CASE WHEN classes = 0 THEN stem
          ELSE coalesce(nullif(regexp_extract(stem, '(?i)^(.*?(?:^|[^A-Za-z]))(?:BPD|TED|TSD)(?:[^A-Za-z]|$)', 1), ''), '') END AS prefix FROM named)"""
CTES["hinted"] = """
  SELECT *, nullif(array_to_string(CASE WHEN area IS NOT NULL AND len(runs) > 1 AND runs[1] = area THEN runs[2:] ELSE runs END, '_'), '') AS hint
  FROM hints0"""
CTES["file_points"] = """
  SELECT *, CASE WHEN kind = 'empty' THEN 'empty_file' WHEN kind = 'garbage' THEN 'not_an_imagej_roi'
                 WHEN kind = 'polygon' THEN 'not_a_point_roi' WHEN kind = 'page' THEN 'roi_refers_to_another_page' END AS decode_problem,
         [(custkey * 7 + i * 13) % 400 + 10 + CAST(CASE WHEN subpixel_wanted THEN 0.25 ELSE 0.5 END AS DOUBLE) FOR i IN range(points_wanted)] AS xs,
         [(custkey * 11 + i * 29) % 180 + 10 + CAST(CASE WHEN subpixel_wanted THEN 0.75 ELSE 0.5 END AS DOUBLE) FOR i IN range(points_wanted)] AS ys
  FROM hinted"""
CTES["file_keys"] = """
  SELECT *, CAST(xs AS VARCHAR) || CAST(ys AS VARCHAR) AS coords FROM file_points"""
CTES["listing"] = _shared(S.RASTER_FILES, "supplier")
CTES["listed"] = f"""
  SELECT *, regexp_extract(relpath, '^(.*)/[^/]*$', 1) AS directory, regexp_extract(relpath, '([^/]*)\\.[^./]*$', 1) AS stem,
         lower(regexp_extract(relpath, '(\\.[^./]*)$', 1)) AS ext,
         {_stage("regexp_extract(relpath, '([^/]*)[.][^./]*$', 1)")} AS stage
  FROM listing"""
CTES["directories"] = """
  SELECT directory,
         count(*) FILTER (ext IN ('.tif', '.tiff')) AS all_tiffs, min(relpath) FILTER (ext IN ('.tif', '.tiff')) AS all_tiff,
         count(*) FILTER (ext IN ('.tif', '.tiff') AND stage = 'before') AS before_tiffs,
         min(relpath) FILTER (ext IN ('.tif', '.tiff') AND stage = 'before') AS before_tiff,
         count(*) FILTER (ext IN ('.tif', '.tiff') AND stage = 'after') AS after_tiffs,
         min(relpath) FILTER (ext IN ('.tif', '.tiff') AND stage = 'after') AS after_tiff,
         bool_or(ext IN ('.jpg', '.jpeg')) AS has_jpeg
  FROM listed GROUP BY directory"""
CTES["linked0"] = """
  SELECT f.*, coalesce(d.all_tiffs, 0) AS tiffs, d.all_tiff, coalesce(d.has_jpeg, false) AS has_jpeg,
         (SELECT max(l.stage) FROM listed l WHERE l.relpath = d.all_tiff) AS tiff_stage,
         CASE f.stage WHEN 'before' THEN d.before_tiffs WHEN 'after' THEN d.after_tiffs END AS stage_tiffs,
         CASE f.stage WHEN 'before' THEN d.before_tiff WHEN 'after' THEN d.after_tiff END AS stage_tiff
  FROM file_keys f LEFT JOIN directories d ON f.directory = d.directory"""
CTES["linked1"] = r"""
  SELECT *, CASE WHEN regexp_matches(split_part(directory, '/', 2), '(?i)x\s*100') THEN 'x100_magnified_image_different_scale'
                 WHEN tiffs = 0 AND has_jpeg THEN 'no_tiff_in_directory_jpg_only' WHEN tiffs = 0 THEN 'no_tiff_in_directory'
                 WHEN tiffs > 1 AND stage IS NULL THEN 'ambiguous_tiff_no_stage_in_name'
                 WHEN tiffs > 1 AND stage_tiffs <> 1 THEN 'ambiguous_tiff_for_stage'
                 WHEN tiffs = 1 AND stage <> tiff_stage THEN 'roi_stage_conflicts_with_tiff' END AS mapping_problem
  FROM linked0"""
CTES["linked"] = """
  SELECT *, CASE WHEN mapping_problem IS NULL THEN CASE WHEN tiffs = 1 THEN all_tiff ELSE stage_tiff END END AS image,
         CASE WHEN mapping_problem IS NULL THEN CASE WHEN tiffs = 1 THEN 'same_directory_unique_tiff'
              ELSE 'same_directory_tiff_matching_stage' END END AS mapping_basis
  FROM linked1"""
CTES["bytes_first"] = """
  SELECT *, CASE WHEN area IS NULL THEN 'no_area_folder' ELSE coalesce(problem, decode_problem) END AS own,
         CASE WHEN area IS NULL OR problem IS NOT NULL OR decode_problem IS NOT NULL THEN NULL ELSE first_value(relpath) OVER (
           PARTITION BY area IS NULL OR problem IS NOT NULL OR decode_problem IS NOT NULL, coords, variant, subpixel_wanted
           ORDER BY in_set, lower(relpath), relpath) END AS first_bytes
  FROM linked"""
CTES["mapped0"] = r"""
  SELECT *, coalesce(own, CASE WHEN first_bytes <> relpath THEN 'duplicate_bytes' END, mapping_problem) AS reason0,
         CASE WHEN first_bytes <> relpath THEN first_bytes END AS bytes_of,
         regexp_extract_all(regexp_extract(image, '([^/]*)\.[^./]*$', 1), '\d+') AS image_runs
  FROM bytes_first"""
CTES["mapped1"] = """
  SELECT *, CASE WHEN reason0 IS NULL AND hint IS NOT NULL THEN
           CASE WHEN len(image_runs) = 0 THEN false ELSE hint IN (array_to_string(image_runs, '_'), image_runs[1]) END END AS matches
  FROM mapped0"""
CTES["mapped2"] = """
  SELECT *, CASE WHEN reason0 IS NULL THEN first_value(relpath) OVER (
           PARTITION BY reason0 IS NULL, image, label, subtype, coords
           ORDER BY coalesce(NOT matches, false), in_set, lower(relpath), relpath) END AS first_coords
  FROM mapped1"""
CTES["status"] = """
  SELECT relpath, CASE WHEN reason0 IS NULL AND first_coords = relpath THEN 'mapped' ELSE 'excluded' END AS status,
         coalesce(reason0, CASE WHEN first_coords <> relpath THEN 'duplicate_coordinates' END) AS reason,
         coalesce(bytes_of, CASE WHEN first_coords <> relpath THEN first_coords END) AS duplicate_of,
         CASE WHEN area IS NOT NULL AND problem IS NULL AND decode_problem IS NULL THEN len(xs) END AS point_count,
         CASE WHEN reason0 IS NULL THEN image END AS image, CASE WHEN reason0 IS NULL THEN mapping_basis END AS mapping_basis,
         CASE WHEN reason0 IS NULL THEN hint END AS image_hint_in_name, matches AS hint_matches_image,
         CASE WHEN label IS NOT NULL THEN concat_ws('_', label, subtype) END AS fine_label, area, stage, in_set
  FROM mapped2"""

# ------------------------------------------------------------------ points
CTES["pts"] = _shared(S.POINTS, "events")
CTES["refs"] = f"""
  SELECT *, round_even(x, 4) AS key_x, round_even(y, 4) AS key_y,
         substr(sha256(image || '|' || fine_label || '|' || printf('%.4f', round_even(x, 4)) || '|' || printf('%.4f', round_even(y, 4))), 1, 20) AS point_id
  FROM ({_shared(S.COARSE_POINTS, 'events')})"""
CTES["uniq"] = """
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY image, fine_label, key_x, key_y) AS ref_count,
                        row_number() OVER (PARTITION BY image, fine_label, key_x, key_y ORDER BY file_no, "index") AS rn FROM refs)
  WHERE rn = 1"""
CTES["located"] = """
  SELECT u.*, (SELECT count(DISTINCT o.fine_label) FROM uniq o WHERE o.image = u.image AND o.key_x = u.key_x AND o.key_y = u.key_y) AS labels_here
  FROM uniq u"""


def _neighbors(table: str, half: float, center: float) -> str:
    near = f"abs(a.x - b.x) < {half} AND abs(a.y - b.y) < {half}"
    return f"""
  SELECT a.image, a.point_id,
         count(*) FILTER (a.fine_label = b.fine_label AND a.point_id <> b.point_id) AS neighbors_same_label_in_patch,
         count(*) FILTER (a.fine_label <> b.fine_label) AS neighbors_other_label_in_patch,
         count(*) FILTER (a.fine_label <> b.fine_label AND abs(a.x - b.x) < {center} AND abs(a.y - b.y) < {center}) AS neighbors_other_label_in_center
  FROM {table} a JOIN {table} b ON a.image = b.image AND {near} GROUP BY a.image, a.point_id"""


CTES["near_uniq"] = _neighbors("uniq", 16, 4)
CTES["judged0"] = """
  SELECT l.*, n.* EXCLUDE (image, point_id), CAST(floor(x) AS BIGINT) AS center_x, CAST(floor(y) AS BIGINT) AS center_y,
         CAST(floor(x) AS BIGINT) - 16 AS "left", CAST(floor(y) AS BIGINT) - 16 AS top
  FROM located l JOIN near_uniq n ON l.image = n.image AND l.point_id = n.point_id"""
CTES["judged1"] = f"""
  SELECT *, CASE WHEN NOT (x >= 0 AND x < {S.COARSE_WIDTH} AND y >= 0 AND y < {S.COARSE_HEIGHT}) THEN 'point_outside_image'
                 WHEN labels_here > 1 THEN 'same_coordinate_conflicting_labels'
                 WHEN neighbors_other_label_in_center > 0 THEN 'other_label_within_center_8px'
                 WHEN "left" < 0 OR top < 0 OR "left" + 32 > {S.COARSE_WIDTH} OR top + 32 > {S.COARSE_HEIGHT} THEN 'patch_crosses_image_boundary' END AS reason
  FROM judged0"""
CTES["judged"] = "SELECT *, CASE WHEN reason IS NULL THEN 'included' ELSE 'excluded' END AS status FROM judged1"
SPLIT = ("CASE WHEN CAST(area AS INT) >= 44 THEN 'unassigned' WHEN CAST(area AS INT) % 3 = 0 THEN 'train' "
         "WHEN CAST(area AS INT) % 3 = 1 THEN 'val' ELSE 'test' END")
CTES["samples"] = f"""
  SELECT *, {SPLIT} AS split, fine_label AS label, CASE WHEN file_no % 3 = 0 THEN '-' ELSE 's' || CAST(file_no % 3 AS VARCHAR) END AS subtype
  FROM judged WHERE status = 'included'"""
CTES["split_n"] = "SELECT split, label, subtype, count(*) AS n FROM samples GROUP BY split, label, subtype"

# ------------------------------------------------------------------ rasters (one hex string per row)
HEX = 2 * S.LINE
CTES["texts"] = f"""
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS image, source, hex(encode(text)) AS data,
         CAST(ceil(octet_length(encode(text)) / {S.LINE}) AS INT) AS height FROM documents"""
CTES["docrows"] = f"""
  SELECT doc_id, image, source, height, row_no, rpad(substr(data, row_no * {HEX} + 1, {HEX}), {HEX}, '0') AS h
  FROM (SELECT *, unnest(range(height)) AS row_no FROM texts)"""
CTES["tiff"] = f"""
  SELECT doc_id, image, height, row_no, h AS original,
         CASE WHEN doc_id % 6 IN (1, 4) AND (row_no * 7 + doc_id) % 10 < 3 AND row_no % 2 = 0 THEN repeat('FF', 30) || substr(h, 61)
              WHEN doc_id % 6 IN (1, 4) AND (row_no * 7 + doc_id) % 10 < 3 THEN repeat('00', {S.LINE})
              WHEN doc_id % 6 = 2 THEN substr(h, 1, {HEX - 2}) || '07'
              WHEN doc_id % 6 = 5 THEN repeat('41', {S.LINE}) ELSE h END AS px
  FROM docrows"""
PIXELS = f"[substr({{0}}, 6 * i + 1, 6) FOR i IN range({S.WIDTH})]"
MIRROR = f"array_to_string(list_reverse({PIXELS}), '')"
CTES["twin0"] = f"""
  SELECT doc_id, image, row_no, h, doc_id % 4 AS t, CASE WHEN doc_id % 13 = 0 AND height > 1 THEN height - 1 ELSE height END AS height
  FROM docrows WHERE source <> 'src3' AND NOT (doc_id % 13 = 0 AND height > 1 AND row_no = height - 1)"""
CTES["twin"] = f"""
  SELECT image, height, CASE WHEN t IN (2, 3) THEN height - 1 - row_no ELSE row_no END AS row_no,
         CASE WHEN t IN (1, 3) THEN {MIRROR.format('h')} ELSE h END AS px
  FROM twin0"""
CTES["candidates"] = f"""
  SELECT image, height, 'identity' AS transform, row_no, px FROM twin
  UNION ALL SELECT image, height, 'hflip', row_no, {MIRROR.format('px')} FROM twin
  UNION ALL SELECT image, height, 'vflip', height - 1 - row_no, px FROM twin
  UNION ALL SELECT image, height, 'rot180', height - 1 - row_no, {MIRROR.format('px')} FROM twin"""
CTES["agreement"] = """
  SELECT c.image, c.transform, bool_and(c.height = t.h) AS same_size,
         round_even(CASE WHEN bool_and(c.height = t.h) THEN count(*) FILTER (r.px = c.px) / CAST(max(t.h) AS DOUBLE) ELSE 0.0 END, 6) AS agreement
  FROM candidates c JOIN (SELECT image, max(height) AS h FROM tiff GROUP BY image) t ON c.image = t.image
  LEFT JOIN tiff r ON r.image = c.image AND r.row_no = c.row_no GROUP BY c.image, c.transform"""
RANK = "CASE transform WHEN 'identity' THEN 0 WHEN 'hflip' THEN 1 WHEN 'vflip' THEN 2 ELSE 3 END"
CTES["best"] = f"""
  SELECT image, transform AS best, agreement AS best_score FROM (
    SELECT *, row_number() OVER (PARTITION BY image ORDER BY agreement DESC, {RANK}) AS rn FROM agreement) WHERE rn = 1"""
GREY = ("[CAST('0x' || substr({0}, 6 * i + 1, 2) AS INT) + CAST('0x' || substr({0}, 6 * i + 3, 2) AS INT)"
        " + CAST('0x' || substr({0}, 6 * i + 5, 2) AS INT) FOR i IN range({1}, {2}, {3})]")
CTES["small_tiff"] = f"SELECT image, row_no // 2 AS r, {GREY.format('px', 0, S.WIDTH, 2)} AS g FROM tiff WHERE row_no % 2 = 0"
CTES["small_twin"] = f"""
  SELECT image, row_no // 2 AS r, (height - 1) // 2 AS last, {GREY.format('px', 0, S.WIDTH, 2)} AS g FROM twin
  WHERE row_no % 2 = 0 AND image IN (SELECT image FROM agreement WHERE same_size)"""
CTES["small_pairs"] = """
  SELECT t.image, 'identity' AS transform, unnest(t.g) AS a, unnest(c.g) AS b FROM small_tiff t JOIN small_twin c ON t.image = c.image AND t.r = c.r
  UNION ALL SELECT t.image, 'hflip', unnest(t.g), unnest(list_reverse(c.g)) FROM small_tiff t JOIN small_twin c ON t.image = c.image AND t.r = c.r
  UNION ALL SELECT t.image, 'vflip', unnest(t.g), unnest(c.g) FROM small_tiff t JOIN small_twin c ON t.image = c.image AND t.r = c.last - c.r
  UNION ALL SELECT t.image, 'rot180', unnest(t.g), unnest(list_reverse(c.g)) FROM small_tiff t JOIN small_twin c ON t.image = c.image AND t.r = c.last - c.r"""
CTES["corrs"] = """
  SELECT image, transform, CASE WHEN stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN round_even(
    (count(*) * sum(CAST(a AS HUGEINT) * b) - sum(CAST(a AS HUGEINT)) * sum(b)) / (sqrt(CAST(count(*) * sum(CAST(a AS HUGEINT) * a) - sum(CAST(a AS HUGEINT)) * sum(a) AS DOUBLE))
      * sqrt(CAST(count(*) * sum(CAST(b AS HUGEINT) * b) - sum(CAST(b AS HUGEINT)) * sum(b) AS DOUBLE))), 4) ELSE 0.0 END AS correlation
  FROM small_pairs GROUP BY image, transform"""
CTES["relations"] = f"""
  SELECT image, CASE WHEN correlation >= 0.3 AND correlation - next >= 0.2 THEN transform ELSE 'undetermined' END AS relation FROM (
    SELECT *, row_number() OVER w AS rn, lead(correlation) OVER w AS next FROM corrs
    WINDOW w AS (PARTITION BY image ORDER BY correlation DESC, {RANK})) WHERE rn = 1"""
CTES["sources"] = """
  SELECT i.image, CASE WHEN b.image IS NULL THEN 'none' WHEN b.best_score >= 0.01 THEN b.best ELSE coalesce(r.relation, 'undetermined') END AS jpeg_to_tiff,
         CASE WHEN b.best_score < 1 AND b.best_score >= 0.01 THEN 'jpeg_' || b.best ELSE 'tiff' END AS pixel_source,
         CASE WHEN b.image IS NULL THEN 'no_jpeg_pair_unverified' WHEN b.best_score = 1 THEN 'tiff_bit_identical_to_jpeg_' || b.best
              WHEN b.best_score >= 0.01 THEN 'tiff_damaged_rebuilt_from_jpeg' ELSE 'tiff_not_an_exact_copy_of_jpeg_used_as_is' END AS pixel_check
  FROM (SELECT DISTINCT image FROM tiff) i LEFT JOIN best b ON i.image = b.image LEFT JOIN relations r ON i.image = r.image"""
CTES["diffs"] = f"""
  SELECT image, row_no, i, substr(px, 6 * i + 1, 6) AS a FROM (SELECT *, unnest(range({S.WIDTH})) AS i FROM tiff WHERE px <> original)
  WHERE substr(px, 6 * i + 1, 6) <> substr(original, 6 * i + 1, 6)"""
CTES["dense"] = "SELECT DISTINCT " + ", ".join(f'{sql} AS {name}' for name, sql in S.DENSE_POINTS.items()).replace("AS STRING", "AS VARCHAR") + " FROM lineitem"
CTES["dense_spots"] = "SELECT x, y, fine_label, count(*) AS n FROM dense GROUP BY x, y, fine_label"
CTES["dense_boxes"] = """
  SELECT a.x, a.y, a.fine_label, CAST(sum(b.n) AS BIGINT) AS everything, CAST(sum(b.n) FILTER (a.fine_label = b.fine_label) AS BIGINT) AS same,
         CAST(coalesce(sum(b.n) FILTER (abs(a.x - b.x) < 12 AND abs(a.y - b.y) < 12), 0) AS BIGINT) AS near,
         CAST(coalesce(sum(b.n) FILTER (abs(a.x - b.x) < 12 AND abs(a.y - b.y) < 12 AND a.fine_label = b.fine_label), 0) AS BIGINT) AS near_same
  FROM dense_spots a JOIN dense_spots b ON abs(a.x - b.x) < 40 AND abs(a.y - b.y) < 40 GROUP BY a.x, a.y, a.fine_label"""
CTES["tree_refs"] = _shared(S.TREE_POINTS, "events")
CTES["tree_points"] = """
  SELECT DISTINCT CAST(r.image_no AS VARCHAR) AS image, r.fine_label, r.px + 0.5::DOUBLE AS x, r.row_seed % t.height + 0.5::DOUBLE AS y, t.height
  FROM tree_refs r JOIN texts t ON t.image = CAST(r.image_no AS VARCHAR)"""
CTES["tree_judged"] = f"""
  SELECT p.*, CASE WHEN CAST(p.image AS BIGINT) % 10 IN (1, 9) THEN 'train' WHEN CAST(p.image AS BIGINT) % 10 = 2 THEN 'val'
      WHEN CAST(p.image AS BIGINT) % 10 = 8 THEN 'test' ELSE 'unassigned' END AS split,
    CASE WHEN EXISTS (SELECT 1 FROM tree_points q WHERE q.image = p.image AND q.x = p.x AND q.y = p.y AND q.fine_label <> p.fine_label)
      THEN 'same_coordinate_conflicting_labels'
    WHEN EXISTS (SELECT 1 FROM tree_points q WHERE q.image = p.image AND q.fine_label <> p.fine_label AND abs(q.x - p.x) < 2 AND abs(q.y - p.y) < 2)
      THEN 'other_label_within_center_4px'
    WHEN floor(p.x) - 4 < 0 OR floor(p.y) - 4 < 0 OR floor(p.x) + 4 > {S.WIDTH} OR floor(p.y) + 4 > p.height
      THEN 'patch_crosses_image_boundary' END AS reason FROM tree_points p"""
CTES["ranges"] = """
  SELECT doc_id, no, least(1000, size - 1000 * no) AS length, sha256(unhex(substr(h, CAST(2000 * no + 1 AS BIGINT), 2000))) AS digest
  FROM (SELECT *, unnest(range(CAST(greatest(1, ceil(size / 1000.0)) AS BIGINT))) AS no FROM (
    SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS size FROM documents))"""
CTES["range_nodes"] = """
  SELECT doc_id, no // 16 AS no, sum(length) AS length, CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256(unhex(string_agg(digest, '' ORDER BY no))) END AS digest
  FROM ranges GROUP BY doc_id, no // 16"""
CTES["positions"] = """
  SELECT image, CAST(i + 0.5 AS DOUBLE) AS x, CAST(row_no + 0.5 AS DOUBLE) AS y, row_number() OVER (PARTITION BY image ORDER BY row_no, i) AS rn FROM diffs"""
CTES["marks"] = f"""
  SELECT p.*, CAST(row_seed % t.height AS DOUBLE) + 0.25 AS y, t.height FROM ({_shared(S.RASTER_POINTS, 'events')}) p
  JOIN texts t ON p.image = t.image"""
CTES["boxes"] = f"""
  SELECT point_no, image, fine_label, CAST(floor(x) AS INT) - 4 AS "left", CAST(floor(y) AS INT) - 4 AS top FROM marks
  WHERE floor(x) - 4 >= 0 AND floor(y) - 4 >= 0 AND floor(x) + 4 <= {S.WIDTH} AND floor(y) + 4 <= height"""
CTES["patches"] = """
  SELECT b.point_no, b.fine_label, string_agg(substr(t.px, 6 * b."left" + 1, 48), '' ORDER BY t.row_no) AS pixels
  FROM boxes b JOIN tiff t ON t.image = b.image AND t.row_no BETWEEN b.top AND b.top + 7 GROUP BY b.point_no, b.fine_label"""
CTES["means"] = """
  SELECT fine_label, pos, avg(CAST('0x' || substr(pixels, 2 * pos + 1, 2) AS INT)) AS mean
  FROM (SELECT *, unnest(range(192)) AS pos FROM patches) GROUP BY fine_label, pos"""
SHIFT_ROWS = ", ".join(f"({n}, {dx}, {dy})" for n, (dx, dy) in enumerate([(0, 0), *S.SHIFTS]))
CTES["greys"] = f"SELECT image, row_no, {GREY.format('px', 0, S.WIDTH, 1)} AS g FROM tiff"
CTES["windows"] = f"""
  SELECT m.point_no, m.image, m.fine_label, s.shift, list_sum(flatten(list(g.g[CAST(floor(m.x) AS INT) + s.dx : CAST(floor(m.x) AS INT) + s.dx + 2]))) AS total,
         list_sum([v * v FOR v IN flatten(list(g.g[CAST(floor(m.x) AS INT) + s.dx : CAST(floor(m.x) AS INT) + s.dx + 2]))]) AS squares
  FROM marks m, (VALUES {SHIFT_ROWS}) s(shift, dx, dy), greys g
  WHERE floor(m.x) >= 5 AND floor(m.y) >= 5 AND floor(m.x) < {S.WIDTH} - 5 AND floor(m.y) < m.height - 5
    AND g.image = m.image AND g.row_no BETWEEN CAST(floor(m.y) AS INT) + s.dy - 1 AND CAST(floor(m.y) AS INT) + s.dy + 1
  GROUP BY m.point_no, m.image, m.fine_label, s.shift"""
CTES["spreads"] = """
  SELECT point_no, image, fine_label, shift, CAST(9 * squares - total * total AS BIGINT) AS spread,
         sqrt(CAST(9 * squares - total * total AS DOUBLE)) / 27 AS std FROM windows"""

# ------------------------------------------------------------------ decisions
CTES["decisions"] = f"""
  SELECT o_orderkey AS relpath, CAST(o_custkey % 200 AS VARCHAR) AS image, o_orderstatus AS label,
         [{', '.join(f"'{t}'" for t in (*TRANSFORMS, 'none', 'undetermined'))}][o_custkey % 6 + 1] AS relation,
         CASE WHEN o_orderkey % 19 <> 0 THEN round_even(o_totalprice / 150000, 4) END AS a,
         CASE WHEN o_orderkey % 17 <> 0 THEN round_even(CAST((o_orderkey * 7919) % 300 AS DOUBLE) / 100, 4) END AS b,
         o_orderkey % 40 AS n, CASE WHEN o_orderkey % 101 = 0 THEN 'hflip' END AS override FROM orders"""
CTES["decided"] = """
  SELECT *, CASE WHEN override IS NOT NULL THEN override WHEN relation IN ('none', 'undetermined', 'identity') THEN 'identity'
                 WHEN n >= 15 AND a >= 1.15 AND a >= b * CAST(1.10 AS DOUBLE) THEN 'identity' WHEN n >= 15 AND b >= 1.15 AND b >= a * CAST(1.10 AS DOUBLE) THEN relation END AS transform,
         CASE WHEN override IS NOT NULL THEN 'manual_override' WHEN relation IN ('none', 'undetermined', 'identity') THEN 'tiff_grid_only_candidate'
              WHEN n >= 15 AND a >= 1.15 AND a >= b * CAST(1.10 AS DOUBLE) THEN 'contrast_probe_tiff_grid'
              WHEN n >= 15 AND b >= 1.15 AND b >= a * CAST(1.10 AS DOUBLE) THEN 'contrast_probe_raw_jpeg_grid' ELSE 'contrast_probe_inconclusive' END AS basis
  FROM decisions"""
CTES["agreed"] = """
  SELECT image, label, min(transform) AS only_one FROM decided WHERE transform IS NOT NULL AND basis LIKE 'contrast_probe%'
  GROUP BY image, label HAVING count(DISTINCT transform) = 1"""

NESTED = """
  SELECT '{' || string_agg('"' || split || '":{' || labels || '}', ',' ORDER BY split) || '}' AS counts FROM (
    SELECT split, string_agg('"' || label || '":{' || subs || '}', ',' ORDER BY label) AS labels FROM (
      SELECT split, label, string_agg('"' || subtype || '":' || CAST(n AS VARCHAR), ',' ORDER BY subtype) AS subs FROM split_n GROUP BY split, label)
    GROUP BY split)"""
FLIP = (f"SELECT image, CAST(CASE WHEN doc_id % 4 IN (2, 3) THEN height - 1 - row_no ELSE row_no END AS INT) AS row_no, "
        f"CASE WHEN doc_id % 4 IN (1, 3) THEN {MIRROR.format('h')} ELSE h END AS px FROM docrows")
CONTRAST = """
        SELECT {0}, count(*) FILTER (shift = 0) AS points_used, round_even(median(std) FILTER (shift = 0), 3) AS median_std_points,
               round_even(median(std) FILTER (shift > 0), 3) AS median_std_controls,
               CASE WHEN median(std) FILTER (shift > 0) > 0 THEN round_even(median(std) FILTER (shift = 0) / median(std) FILTER (shift > 0), 4) END AS ratio
        FROM spreads GROUP BY {0}"""
DISTANCE = "sqrt((p.x - m.x) * (p.x - m.x) + (p.y - m.y) * (p.y - m.y))"

QUERIES: dict[str, str] = {
    "parse_label": "SELECT relpath, label, subtype, CASE WHEN label IS NOT NULL THEN concat_ws('_', label, subtype) END AS fine_label, problem FROM named",
    "stage_and_area": r"SELECT relpath, area, stage, in_set, directory, regexp_matches(split_part(directory, '/', 2), '(?i)x\s*100') AS magnified FROM named",
    "image_hint": """
        SELECT relpath, hint, digits, matches, CASE WHEN matches = false THEN 'image_number_in_roi_name_differs_from_tiff_name' ELSE '' END AS warnings
        FROM (SELECT *, CASE WHEN hint IS NULL THEN NULL WHEN digits IS NULL THEN false ELSE hint = digits OR hint = split_part(digits, '_', 1) END AS matches
              FROM (SELECT *, CASE WHEN file_id % 9 <> 0 THEN CAST(file_id % 4 AS VARCHAR) || '_7' END AS digits FROM hinted))""",
    "decode_points": """
        SELECT relpath, subpixel_wanted AS subpixel, CAST(NULL AS VARCHAR) AS problem, i AS "index", xs[i + 1] AS x, ys[i + 1] AS y
        FROM (SELECT *, unnest(range(len(xs))) AS i FROM file_points WHERE decode_problem IS NULL)
        UNION ALL SELECT relpath, NULL, decode_problem, NULL, NULL, NULL FROM file_points WHERE decode_problem IS NOT NULL""",
    "dedup_by_content": """
        SELECT relpath, CASE WHEN decode_problem IS NULL AND winner <> relpath THEN winner END AS duplicate_of FROM (
          SELECT *, first_value(relpath) OVER (PARTITION BY decode_problem IS NULL, coords, variant, subpixel_wanted ORDER BY in_set, lower(relpath), relpath) AS winner FROM file_keys)""",
    "document_copies": """
        SELECT doc_id, sha256, CASE WHEN winner <> doc_id THEN winner END AS duplicate_of FROM (
          SELECT doc_id, sha256(text) AS sha256, min(doc_id) OVER (PARTITION BY text) AS winner FROM documents)""",
    "directory_listing": "SELECT * FROM directories",
    "raster_twins": r"""
        SELECT relpath AS image, CASE WHEN CAST(regexp_extract(relpath, '(\d+)\.[^.]*$', 1) AS BIGINT) % 3 <> 0
          THEN regexp_replace(relpath, '\.[^./]*$', '.jpg') END AS twin FROM listed WHERE ext IN ('.tif', '.tiff')""",
    "map_files": "SELECT relpath, image, mapping_basis, mapping_problem FROM linked",
    "file_status": "SELECT relpath, status, reason, duplicate_of, point_count, image, mapping_basis, image_hint_in_name, hint_matches_image FROM status",
    "excluded_files": "SELECT relpath, reason, duplicate_of, point_count, fine_label AS label FROM status WHERE status = 'excluded'",
    "supplied_points": "SELECT fine_label, CAST(sum(point_count) AS BIGINT) AS points FROM status WHERE status = 'mapped' GROUP BY fine_label",
    "image_files": """
        SELECT relpath, image, count(*) OVER w AS n, first_value(area) OVER w AS area, first_value(stage) OVER w AS stage
        FROM status WHERE status = 'mapped'
        WINDOW w AS (PARTITION BY image ORDER BY in_set, lower(relpath), relpath ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "changed_sources": "SELECT relpath FROM listing WHERE bytes % 7000 = 0",
    "dedup_points": 'SELECT image, fine_label, key_x, key_y, ref_count, file_no, "index", roi, x, y, point_id FROM uniq',
    "point_lineage": """
        SELECT point_id, '{"roi":"' || roi || '","index":' || CAST("index" AS VARCHAR) || '}' AS roi_ref FROM refs""",
    "lineage_rows": 'SELECT point_id, file_no, "index", roi FROM refs',
    "files_per_point": "SELECT point_id, count(DISTINCT roi) AS roi_files FROM refs GROUP BY point_id",
    "labels_at_location": "SELECT image, key_x, key_y, fine_label, labels_here FROM located",
    "box_neighbor_counts": _neighbors("pts", 64, 16),
    "box_neighbors_crowded": _neighbors("pts", 64, 16),
    "box_neighbors_dense": """
        SELECT d.image, d.point_id, same - 1 AS neighbors_same_label_in_patch, everything - same AS neighbors_other_label_in_patch,
               near - near_same AS neighbors_other_label_in_center
        FROM dense d JOIN dense_boxes b ON b.x = d.x AND b.y = d.y AND b.fine_label = d.fine_label""",
    "point_rules": """
        SELECT point_id, image, fine_label, center_x, center_y, "left", top, status, reason,
               neighbors_same_label_in_patch, neighbors_other_label_in_patch, neighbors_other_label_in_center FROM judged""",
    "transform_points": " UNION ALL ".join(
        f"SELECT point_id, '{t}' AS transform, round_even({'500 - x' if t in ('hflip', 'rot180') else 'x'}, 6) AS x, "
        f"round_even({'1000 - y' if t in ('vflip', 'rot180') else 'y'}, 6) AS y FROM pts" for t in TRANSFORMS),
    "assign_split": """
        SELECT r."index", r.area, coalesce(['train', 'val', 'test'][n.n_regionkey % 3 + 1], 'unassigned') AS split
        FROM refs r LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = r.area""",
    "split_leakage": f"""
        SELECT area, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM (
          SELECT area, CASE WHEN "index" % 97 = 0 AND file_no < 9 THEN 'test' ELSE {SPLIT} END AS split FROM refs)
        GROUP BY area HAVING count(DISTINCT split) > 1""",
    "split_counts": "SELECT * FROM split_n",
    "nested_counts": NESTED,
    "label_totals": "SELECT fine_label, count(*) AS n FROM samples GROUP BY fine_label",
    "rare_labels": """
        SELECT l.fine_label, count(s.fine_label) AS n FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('unused')) l(fine_label)
        LEFT JOIN samples s ON s.fine_label = l.fine_label GROUP BY l.fine_label HAVING count(s.fine_label) < 1000000""",
    "excluded_points": "SELECT reason, count(*) AS n FROM judged WHERE status <> 'included' GROUP BY reason",
    "duplicate_refs": "SELECT CAST(sum(ref_count - 1) AS BIGINT) AS duplicate_point_refs FROM uniq",
    "image_totals": "SELECT image, count(*) FILTER (status = 'included') AS included, count(*) AS unique_points FROM judged GROUP BY image",
    "samples_by_path": """
        SELECT 'patches_32/' || split || '/' || fine_label || '/' || point_id AS path, point_id, false AS expert_verified,
               'provider' AS labels_source, 'provider_label_unverified' AS review_status FROM samples ORDER BY path""",
    "sample_per_label": """
        SELECT fine_label, point_id, CAST(rn AS INT) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY fine_label ORDER BY sha256(point_id)) AS rn FROM pts) WHERE rn <= 8""",
    "label_domain": "SELECT point_id, fine_label FROM pts WHERE fine_label NOT IN ('click', 'error', 'signup', 'view')",
    "split_domain": "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')",
    "hash_mismatches": """
        SELECT 'd' || CAST(doc_id AS VARCHAR) AS relpath, sha256(text) AS sha256, CASE WHEN doc_id % 41 <> 0 THEN sha256(text || '!') END AS actual
        FROM documents WHERE doc_id % 41 = 0 OR doc_id % 17 = 0""",
    "row_agreement": "SELECT image, transform, agreement, same_size FROM agreement",
    "best_transform": "SELECT * FROM best",
    "flip_rows": FLIP,
    "correlation": "SELECT * FROM corrs",
    "low_resolution_relation": "SELECT * FROM relations",
    "pixel_source": "SELECT * FROM sources",
    "rebuilt_rows": f"""
        SELECT t.image, CAST(CASE WHEN c.best IN ('vflip', 'rot180') THEN t.height - 1 - t.row_no ELSE t.row_no END AS INT) AS row_no,
               CASE WHEN c.best IN ('hflip', 'rot180') THEN {MIRROR.format('t.px')} ELSE t.px END AS px
        FROM twin t JOIN (SELECT * FROM best WHERE best_score >= 0.01 AND best_score < 1) c ON c.image = t.image""",
    "difference_report": f"""
        SELECT t.image, count(d.image) AS tiff_differing_pixels, round_even(count(d.image) / ({S.WIDTH}.0::DOUBLE * t.height), 8) AS tiff_differing_pixel_fraction,
               count(*) FILTER (d.a = 'FFFFFF') AS tiff_differing_pixels_pure_white
        FROM texts t LEFT JOIN diffs d ON d.image = t.image GROUP BY t.image, t.height""",
    "difference_positions": "SELECT image, x, y FROM positions WHERE rn <= 50",
    "difference_positions_all": "SELECT image, x, y FROM positions",
    "near_point_fraction": f"""
        SELECT image, count(*) AS tested, count(*) FILTER (d <= 2) AS near,
               CASE WHEN max(d) IS NOT NULL THEN round_even(count(*) FILTER (d <= 2) / CAST(count(*) AS DOUBLE), 4) END AS near_fraction
        FROM (SELECT p.image, p.x, p.y, min({DISTANCE}) AS d FROM positions p LEFT JOIN marks m ON m.image = p.image GROUP BY p.image, p.x, p.y)
        GROUP BY image""",
    "nearest_point": f"""
        SELECT p.image, p.x, p.y, round_even(CASE WHEN min({DISTANCE}) <= 2 THEN min({DISTANCE}) END, 6) AS distance
        FROM positions p LEFT JOIN marks m ON m.image = p.image GROUP BY p.image, p.x, p.y""",
    "nearest_point_any": f"""
        SELECT p.image, p.x, p.y, round_even(min({DISTANCE}), 6) AS distance
        FROM positions p LEFT JOIN (SELECT image, x + far AS x, y - far AS y FROM (
          SELECT *, CASE WHEN CAST(image AS BIGINT) % 7 = 0 THEN {S.FAR} ELSE 0.0 END AS far FROM marks)) m
        ON m.image = p.image GROUP BY p.image, p.x, p.y""",
    "crop_patches": "SELECT point_no, pixels FROM patches",
    "patch_shapes": "SELECT point_no FROM patches WHERE point_no % 13 = 5",
    "damaged_samples": """
        SELECT "check", CAST(rn AS INT) AS rank, n AS problems, detail FROM (
          SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY place) AS rn, count(*) OVER (PARTITION BY "check") AS n FROM (
            SELECT 'patches' AS "check", 'patches/' || point_no AS place, 'bad patch patches/' || point_no AS detail FROM patches
            WHERE point_no % 13 = 5 OR point_no % 19 = 4 OR point_no % 23 = 6
            UNION ALL SELECT 'labels', 'patches/' || point_no, 'unknown label ' || CASE WHEN point_no % 2 = 0 THEN 'not_' || fine_label ELSE 'null' END
            FROM patches WHERE point_no % 17 = 3
            UNION ALL SELECT 'splits', area, area || ' (' || min(split) || ', ' || max(split) || ')' FROM (
              SELECT CAST(point_no % 50 AS VARCHAR) AS area,
                     CASE WHEN point_no % 97 = 0 THEN 'test' WHEN point_no % 50 % 2 = 0 THEN 'train' ELSE 'val' END AS split FROM patches)
            GROUP BY area HAVING count(DISTINCT split) > 1)) WHERE rn <= 3""",
    "mean_patch": "SELECT fine_label, pos, round_even(mean, 6) AS mean FROM means",
    "stretched_mean": """
        SELECT m.fine_label, CAST(pos AS INT) AS pos, CAST(floor(greatest(0, least(255, (mean - lo) * 255.0 / greatest(hi - lo, 1e-6)))) AS INT) AS value
        FROM means m JOIN (SELECT fine_label, quantile_cont(mean, 0.01) AS lo, quantile_cont(mean, 0.99) AS hi FROM means GROUP BY fine_label) b
        ON m.fine_label = b.fine_label""",
    "window_spread": "SELECT point_no, CAST(shift AS BIGINT) AS shift, spread, round_even(std, 3) AS std FROM spreads",
    "contrast_ratio": CONTRAST.format("fine_label"),
    "contrast_by_file": CONTRAST.format("image, fine_label"),
    "built_points": """
        SELECT image, split, fine_label, x, y, CASE WHEN reason IS NULL THEN 'included' ELSE 'excluded' END AS status, reason FROM tree_judged""",
    "built_patches": """
        SELECT j.split, j.fine_label, string_agg(substr(t.px, 6 * (CAST(floor(j.x) AS INT) - 4) + 1, 48), '' ORDER BY t.row_no) AS pixels
        FROM tree_judged j JOIN tiff t ON t.image = j.image AND t.row_no BETWEEN floor(j.y) - 4 AND floor(j.y) + 3
        WHERE j.reason IS NULL GROUP BY j.image, j.split, j.fine_label, j.x, j.y""",
    "built_counts": """
        SELECT split AS part, fine_label AS name, count(*) AS n FROM tree_judged WHERE reason IS NULL GROUP BY split, fine_label
        UNION ALL SELECT 'excluded_points_by_reason', reason, count(*) FROM tree_judged WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL SELECT 'by_fine_label', fine_label, count(*) FROM tree_judged WHERE reason IS NULL GROUP BY fine_label
        UNION ALL SELECT 'provider_points_in_used_roi_files', r.fine_label, count(*) FROM tree_refs r JOIN texts t ON t.image = CAST(r.image_no AS VARCHAR) GROUP BY r.fine_label
        UNION ALL SELECT 'whole', 'patches', count(*) FROM tree_judged WHERE reason IS NULL
        UNION ALL SELECT 'whole', 'unique_points', count(*) FROM tree_judged
        UNION ALL SELECT 'whole', 'duplicate_point_refs', (SELECT count(*) FROM tree_refs r JOIN texts t ON t.image = CAST(r.image_no AS VARCHAR)) - count(*) FROM tree_judged
        UNION ALL SELECT 'whole', 'images', count(DISTINCT image) FROM tree_judged""",
    "validated_datasets": """
        SELECT dataset, "check", passed AND (SELECT count(*) > 0 FROM documents) AS passed FROM (VALUES
          ('whole', 'completed', true), ('whole', 'schema', true), ('whole', 'samples_digest', true), ('whole', 'hashes', true),
          ('whole', 'patches', true), ('whole', 'labels', true), ('whole', 'splits', true), ('whole', 'count', true),
          ('marked', 'completed', false), ('altered', 'completed', true), ('altered', 'schema', true), ('altered', 'samples_digest', false),
          ('altered', 'hashes', false), ('altered', 'patches', true), ('altered', 'labels', true), ('altered', 'splits', true),
          ('altered', 'count', true)) v(dataset, "check", passed)""",
    "versioned_rows": "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE doc_id % 3 < 2",
    "points_in_order": 'SELECT image, point_id, file_no, "index" FROM uniq ORDER BY image, file_no, "index"',
    "decide_grid": "SELECT relpath, transform, basis FROM decided",
    "grid_consensus": """
        SELECT d.relpath, coalesce(d.transform, g.only_one) AS transform,
               CASE WHEN d.transform IS NULL AND g.only_one IS NOT NULL THEN 'inherited_from_same_image_same_class_files' ELSE d.basis END AS basis,
               CASE WHEN d.transform IS NULL AND g.only_one IS NULL THEN 'coordinate_grid_undetermined' END AS reason
        FROM decided d LEFT JOIN agreed g ON d.image = g.image AND d.label = g.label""",
    "exact_group_median": """
        SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(quantile_disc(c, 0.5) AS BIGINT) AS lower, CAST(max(u) AS BIGINT) AS upper, (quantile_disc(c, 0.5) + max(u)) / 2.0::DOUBLE AS median
        FROM (SELECT *, CASE WHEN rn = n // 2 + 1 THEN c END AS u FROM (
          SELECT l_returnflag, l_linestatus, CAST(floor(l_extendedprice * 100) AS BIGINT) AS c,
                 count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n,
                 row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY floor(l_extendedprice * 100)) AS rn FROM lineitem))
        GROUP BY l_returnflag, l_linestatus""",
}


QUERIES |= {
    "discovered_files": QUERIES["file_status"],
    "json_read_back": QUERIES["split_counts"],
    "csv_read_back": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer",
    "stored_patches": QUERIES["crop_patches"],
    "stored_spreads": QUERIES["window_spread"],
    "stored_rows": "SELECT image, CAST(row_no AS INT) AS row_no, px FROM tiff",
    "stored_headers": f"""
        SELECT image || '.tif' AS relpath, {S.WIDTH} AS width, height, 8 AS bits, 3 AS samples, 'NONE' AS compression, 'RGB' AS photometric,
               true AS strips, CAST(NULL AS VARCHAR) AS problem FROM texts""",
    "range_roots": """
        SELECT 'd' || CAST(doc_id AS VARCHAR) || '.txt' AS relpath, CAST(sum(length) AS BIGINT) AS bytes,
               CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256(unhex(string_agg(digest, '' ORDER BY no))) END AS root
        FROM range_nodes GROUP BY doc_id""",
    "damaged_ranges": """
        SELECT 'd' || CAST(doc_id AS VARCHAR) || '.txt' AS relpath, doc_id * 37 % size // 1000 AS range_no, doc_id * 37 % size // 1000 * 1000 AS start,
               least(1000, size - doc_id * 37 % size // 1000 * 1000) AS length
        FROM (SELECT doc_id, octet_length(encode(text)) AS size FROM documents) WHERE doc_id % 7 = 0 AND size > 0""",
    "file_digests": "SELECT 'd' || CAST(doc_id AS VARCHAR) || '.txt' AS relpath, sha256(text) AS sha256 FROM documents",
}


def statement(name: str) -> str:
    """Query text with the derived inputs it needs, in order."""
    import re

    needed: set[str] = set()

    def visit(text: str) -> None:
        for key, body in CTES.items():
            if key not in needed and re.search(rf"(?i)(\bfrom|\bjoin|,)\s+{key}\b", text):
                needed.add(key)
                visit(body)

    visit(QUERIES[name])
    # Derived inputs read more than once are computed once.
    whole = " ".join([QUERIES[name], *(CTES[key] for key in needed)])
    many = {key for key in needed if len(re.findall(rf"(?i)(\bfrom|\bjoin|,)\s+{key}\b", whole)) > 1}
    parts = ", ".join(f"{key} AS {'MATERIALIZED ' if key in many else ''}({body})" for key, body in CTES.items() if key in needed)
    return (f"WITH {parts} " if parts else "") + QUERIES[name]


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
