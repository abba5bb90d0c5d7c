"""The same queries as plain SQL for an independent engine."""

from __future__ import annotations

from .queries import COUNTRY, MILESTONE_EVERY, OUTPUT_DIR, RUN_TIME, STATUS_DIR
from .standins import check_clauses

_THREE = ("multimedia", "processed_ids", "failed_ids")
_SIX = (*_THREE, "prior_a", "prior_b", "store_files")
_STAR = ("annotations", "images", "categories", "institutions")

# Extra WITH clauses shared by several queries.
_ID_CTES = """
cat AS (SELECT CAST(gbif_id AS STRING) AS id, count(*) AS n FROM multimedia WHERE gbif_id IS NOT NULL GROUP BY 1),
done AS (SELECT DISTINCT trim(line) AS id FROM processed_ids WHERE trim(line) <> ''),
bad AS (SELECT DISTINCT trim(line) AS id FROM failed_ids WHERE trim(line) <> ''),
st AS (SELECT c.id, c.n, d.id IS NOT NULL AS is_done, b.id IS NOT NULL AS is_failed
       FROM cat c LEFT JOIN done d ON c.id = d.id LEFT JOIN bad b ON c.id = b.id)
"""
_PRIOR_CTE = "prior AS (SELECT DISTINCT gbif_id FROM (SELECT gbif_id FROM prior_a UNION ALL SELECT gbif_id FROM prior_b) u)"
_PATH = "concat('store/', substring(id, 1, 3), '/', CASE WHEN length(id) >= 6 THEN substring(id, 4, 3) ELSE '000' END, '/', id, '.jpg')"
_PLAN_CTE = f"""
plan AS (SELECT CAST(p.id AS BIGINT) AS gbif_id, p.path,  f.length IS NOT NULL AS present,
    CASE WHEN is_done THEN 'done' WHEN is_failed THEN 'failed' WHEN pr.gbif_id IS NOT NULL THEN 'duplicate'
         WHEN f.length IS NULL THEN 'fetch' WHEN f.length / 1048576.0::DOUBLE < 0.01 THEN 'refetch' ELSE 'record_done' END AS action
  FROM (SELECT st.*, {_PATH} AS path FROM st) p
  LEFT JOIN prior pr ON CAST(pr.gbif_id AS STRING) = p.id LEFT JOIN store_files f ON f.path = p.path)
"""
_OUTCOME = """
oc AS (SELECT *, CASE WHEN error_kind = 'timeout' THEN 'timeout' WHEN error_kind IS NOT NULL OR status IS NULL THEN 'exception'
    WHEN status = 429 THEN 'rate_limit' WHEN status >= 500 THEN 'server_error' WHEN status <> 200 THEN 'http_error'
    WHEN coalesce(content_type, '') = '' THEN 'ok_untyped'
    WHEN contains(lower(content_type), 'text/html') OR contains(lower(content_type), 'text/plain') OR contains(lower(content_type), 'application/xml') THEN 'bad_type'
    ELSE 'ok' END AS outcome,
    split_part(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), ':', 1) AS host,
    epoch_us(ts) AS ts_us FROM attempts),
ev AS (SELECT *, CASE WHEN outcome IN ('server_error', 'http_error', 'bad_type', 'exception') THEN 1 ELSE 0 END AS is_error,
    outcome IN ('ok', 'ok_untyped') AS accepted,
    CASE WHEN outcome = 'timeout' THEN 3600000000
         WHEN outcome = 'rate_limit' THEN coalesce(TRY_CAST(retry_after AS BIGINT) * 1000000,
            CASE WHEN named_us IS NOT NULL THEN greatest(named_us - ts_us, 0) END, 1800000000) END AS rest_us
    FROM (SELECT *, epoch_us(try_strptime(retry_after, '%a, %d %b %Y %H:%M:%S GMT')) AS named_us FROM oc) q)
"""
_JOIN22 = """
j AS (SELECT a.id, a.image_id, i.file_name AS filename, c.species, c.genus, c.family, n.collection_code AS institution
  FROM annotations a JOIN (SELECT image_id, max(file_name) AS file_name FROM images GROUP BY 1) i ON a.image_id = i.image_id
  JOIN categories c ON a.category_id = c.category_id JOIN institutions n ON a.institution_id = n.institution_id)
"""
_CAPTION = "concat('This is an image of species ', coalesce(species, 'None'), ', in the genus ', coalesce(genus, 'None'), ' of family ', coalesce(family, 'None'), '. It is part of the collection of institution ', coalesce(institution, 'None'), '.')"
_NAME = "family || ' ' || genus || ' ' || species"
_SPLIT = "CASE WHEN row_number() OVER (ORDER BY md5(CAST(id AS STRING) || '|42')) <= ceil(0.2 * (SELECT count(*) FROM j)) THEN 'val' ELSE 'train' END"
_MANIFEST_CTE = """
mu AS (SELECT url, 3 * s.k + w.k AS pos, concat('http://iiif.example.org/', CAST(pid AS STRING), s.tail, '/full/', CAST(w.width AS STRING), ',/0/default.jpg') AS image_url
  FROM (SELECT url, CAST(regexp_extract(url, '/iiif/([0-9]+)', 1) AS BIGINT) AS pid FROM manifests) m
  JOIN (VALUES (0, ''), (1, 'b')) s(k, tail) ON s.k = 0 OR pid % 30 = 10
  JOIN (VALUES (0, 1600), (1, 1200), (2, 800)) w(k, width) ON true
  WHERE pid % 30 NOT IN (0, 20, 11)),
ex AS (SELECT m.gbif_id, coalesce(u.image_url, m.identifier) AS candidate_url
  FROM multimedia m LEFT JOIN mu u ON u.url = m.identifier
  WHERE m.gbif_id IS NOT NULL AND m.identifier IS NOT NULL)
"""
_PLAIN_STEM = "regexp_replace(regexp_extract(path, '[^/]*$', 0), '\\.[^.]*$', '')"
_IMAGE_FILE = "regexp_matches(path, '\\.(jpg|JPG|jpeg|JPEG|png|PNG|tif|TIF|tiff|TIFF)$')"


def _sql(views: tuple[str, ...], body: str, *ctes: str, recursive: bool = False) -> str:
    clauses = ", ".join([check_clauses(*views), *ctes])
    return f"WITH {'RECURSIVE ' if recursive else ''}{clauses} {body}"


def _ids(body: str) -> str:
    return _sql(_THREE, body, _ID_CTES)


def _log(body: str, *ctes: str, recursive: bool = False) -> str:
    return _sql(("attempts",), body, _OUTCOME, *ctes, recursive=recursive)


def _joined(body: str, *ctes: str) -> str:
    return _sql(_STAR, body, _JOIN22, *ctes)


def _report() -> str:
    """The report, one SELECT per line so that the text can be read off."""
    rule = "'" + "=" * 70 + "'"

    def labelled(label: str, value: str, tail: str = "''") -> str:
        return f"'{label.ljust(41)}' || {value} || {tail}"

    def big(x: str) -> str:
        return f"format('{{:,}}', CAST({x} AS BIGINT))"

    def two(x: str) -> str:
        return f"format('{{:.2f}}', {x})"

    before = [
        f"'Run date: {RUN_TIME}'", "''", rule, "'Image Installation Progress Analysis'", rule, "''",
        "'Loading processed and failed IDs...'", f"'  Status directory: {STATUS_DIR}'",
        f"'  processed_ids.txt: {STATUS_DIR}/processed_ids.txt'", f"'  failed_ids.txt: {STATUS_DIR}/failed_ids.txt'",
        f"'  Processed IDs loaded: ' || {big('n_done')}", f"'  Failed IDs loaded: ' || {big('n_bad')}", "''",
        "'Loading multimedia.txt (this may take a moment)...'", f"'  Total rows in multimedia.txt: ' || {big('total_rows')}", "''",
        rule, "'OVERALL STATISTICS'", rule,
        labelled("Total unique gbifIDs in multimedia.txt:", big("ids")), labelled("Total image URLs in multimedia.txt:", big("total_rows")),
        labelled("Average images per gbifID:", two("total_rows / ids")), "''",
        rule, "'INSTALLATION PROGRESS'", rule,
        labelled("Successfully processed:", big("p")), labelled("Failed:", big("f")),
        labelled("Total attempted (processed + failed):", big("p + f")), labelled("Remaining (not yet attempted):", big("r")), "''",
        labelled("Progress:", two("p / ids * 100"), "'%'"), labelled("Failed:", two("f / ids * 100"), "'%'"),
        labelled("Remaining:", two("r / ids * 100"), "'%'"), "''",
        rule, "'IMAGES PER GBIFID DISTRIBUTION'", rule, "'Number of images | Count of gbifIDs'", "'" + "-" * 35 + "'",
    ]
    after = [
        "''", rule, "'IMAGE URL ANALYSIS'", rule,
        labelled("Image URLs for processed gbifIDs:", big("up")), labelled("Image URLs for failed gbifIDs:", big("uf")),
        labelled("Image URLs for remaining gbifIDs:", big("ur")), labelled("Total:", big("up + uf + ur")), "''",
        rule, "'NOTES'", rule,
        "'- Each gbifID may reference multiple image URLs'",
        "'- The script downloads ONE image per gbifID (trying all URLs until one succeeds)'",
        "'- ''Processed'' means we successfully downloaded at least one image for that ID'",
        "'- ''Failed'' means all image URLs for that ID failed to download'", "''",
        f"CASE WHEN xp + xf > 0 THEN {rule} END", "CASE WHEN xp + xf > 0 THEN 'WARNINGS' END", f"CASE WHEN xp + xf > 0 THEN {rule} END",
        f"CASE WHEN xp > 0 THEN '⚠️  ' || {big('xp')} || ' IDs in processed_ids.txt not found in multimedia.txt' END",
        f"CASE WHEN xf > 0 THEN '⚠️  ' || {big('xf')} || ' IDs in failed_ids.txt not found in multimedia.txt' END",
        "CASE WHEN xp + xf > 0 THEN '' END",
        rule, f"'Summary written to: {OUTPUT_DIR}/summary_202401010000.txt'", rule,
    ]
    rows = [f"SELECT {s} AS s, {i} AS i, {line} AS line FROM m" for s, part in ((0, before), (2, after)) for i, line in enumerate(part)]
    metrics = """
    m AS (SELECT (SELECT count(*) FROM multimedia) AS total_rows, (SELECT count(*) FROM done) AS n_done, (SELECT count(*) FROM bad) AS n_bad,
        count(*) AS ids, count(*) FILTER (is_done) AS p, count(*) FILTER (is_failed) AS f, count(*) FILTER (NOT is_done AND NOT is_failed) AS r,
        coalesce(sum(n) FILTER (is_done), 0) AS up, coalesce(sum(n) FILTER (is_failed), 0) AS uf, coalesce(sum(n) FILTER (NOT is_done AND NOT is_failed), 0) AS ur,
        (SELECT count(*) FROM done WHERE id NOT IN (SELECT id FROM cat)) AS xp, (SELECT count(*) FROM bad WHERE id NOT IN (SELECT id FROM cat)) AS xf
      FROM st)
    """
    spread = "SELECT 1 AS s, n AS i, printf('%16d', n) || ' | ' || format('{:,}', count(*)) AS line FROM cat GROUP BY n"
    body = (
        f"SELECT CAST(row_number() OVER (ORDER BY s, i) AS INT) AS line_no, line FROM ({' UNION ALL '.join(rows)} UNION ALL {spread}) x "
        "WHERE line IS NOT NULL"
    )
    return _sql(_THREE, body, _ID_CTES, metrics)


_GUARD = """
o AS (SELECT attempt_id, host, ts_us, is_error, rest_us, row_number() OVER (PARTITION BY host ORDER BY ts_us, attempt_id) AS rn FROM ev),
g AS (SELECT host, rn, attempt_id,
        'sent' AS decision, is_error AS errs, CASE WHEN rest_us IS NULL THEN 0 ELSE ts_us + rest_us END AS until_us FROM o WHERE rn = 1
      UNION ALL
      SELECT o.host, o.rn, o.attempt_id,
        CASE WHEN g.errs >= 50 THEN 'skip_breaker' WHEN o.ts_us < g.until_us THEN 'skip_cooldown' ELSE 'sent' END,
        g.errs + CASE WHEN g.errs < 50 AND o.ts_us >= g.until_us THEN o.is_error ELSE 0 END,
        CASE WHEN g.errs < 50 AND o.ts_us >= g.until_us AND o.rest_us IS NOT NULL THEN o.ts_us + o.rest_us ELSE g.until_us END
      FROM g JOIN o ON o.host = g.host AND o.rn = g.rn + 1)
"""

ORACLES: dict[str, str] = {
    "q_progress": _ids(
        """SELECT count(*) AS total_ids, count(*) FILTER (is_done) AS processed, count(*) FILTER (is_failed) AS failed,
        count(*) FILTER (is_done) + count(*) FILTER (is_failed) AS attempted, count(*) FILTER (NOT is_done AND NOT is_failed) AS remaining,
        round(count(*) FILTER (is_done) / count(*) * 100, 6) AS pct_processed, round(count(*) FILTER (is_failed) / count(*) * 100, 6) AS pct_failed,
        round(count(*) FILTER (NOT is_done AND NOT is_failed) / count(*) * 100, 6) AS pct_remaining FROM st"""
    ),
    "q_id_set": _ids("SELECT id FROM done"),
    "q_catalogue_stats": _sql(
        ("multimedia",),
        "SELECT count(*) AS total_rows, count(DISTINCT gbif_id) AS unique_ids, round(count(*) / count(DISTINCT gbif_id), 6) AS avg_urls FROM multimedia",
    ),
    "q_distribution": _ids("SELECT n AS num_images, count(*) AS id_count FROM cat GROUP BY n"),
    "q_urls_by_state": _ids(
        """, u AS (SELECT 'processed' AS state, n FROM st WHERE is_done UNION ALL SELECT 'failed', n FROM st WHERE is_failed
             UNION ALL SELECT 'remaining', n FROM st WHERE NOT is_done AND NOT is_failed)
        SELECT state, CAST(sum(n) AS BIGINT) AS url_count FROM u GROUP BY state UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM u"""
    ),
    "q_extra_ids": _ids(
        """SELECT 'processed' AS list_name, id FROM done WHERE id NOT IN (SELECT id FROM cat)
        UNION ALL SELECT 'failed', id FROM bad WHERE id NOT IN (SELECT id FROM cat)"""
    ),
    "q_report_lines": _report(),
    "q_candidates": _sql(
        ("multimedia",),
        """SELECT gbif_id, count(*) AS n_urls, string_agg(coalesce(identifier, ''), '|' ORDER BY row_id, identifier) AS urls
        FROM multimedia WHERE gbif_id IS NOT NULL GROUP BY gbif_id""",
    ),
    "q_country_filter": _sql(("multimedia",), f"SELECT row_id, gbif_id FROM multimedia WHERE country_code = '{COUNTRY}'"),
    "q_hosts": _sql(
        ("multimedia",),
        """SELECT split_part(regexp_extract(identifier, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), ':', 1) AS host, count(*) AS n_urls
        FROM multimedia WHERE identifier IS NOT NULL GROUP BY 1""",
    ),
    "q_store_path": _ids(
        f"""SELECT CAST(id AS BIGINT) AS gbif_id, substring(id, 1, 3) AS prefix1,
        CASE WHEN length(id) >= 6 THEN substring(id, 4, 3) ELSE '000' END AS prefix2, {_PATH} AS store_path FROM cat"""
    ),
    "q_prior_ids": _sql(("prior_a", "prior_b"), "SELECT gbif_id FROM prior", _PRIOR_CTE),
    "q_duplicates": _sql(
        ("multimedia", "prior_a", "prior_b"),
        "SELECT DISTINCT gbif_id FROM multimedia WHERE gbif_id IN (SELECT gbif_id FROM prior)",
        _PRIOR_CTE,
    ),
    "q_resume": _ids("SELECT CAST(id AS BIGINT) AS gbif_id FROM st WHERE NOT is_done AND NOT is_failed"),
    "q_install_plan": _sql(_SIX, "SELECT gbif_id, action FROM plan", _ID_CTES, _PRIOR_CTE, _PLAN_CTE),
    "q_duplicate_removals": _sql(
        _SIX, "SELECT gbif_id, path FROM plan WHERE action = 'duplicate' AND present", _ID_CTES, _PRIOR_CTE, _PLAN_CTE
    ),
    "q_store_count": _sql(
        ("files", "store_files"),
        """SELECT 'flat' AS folder, count(*) AS n_files, round(CAST(sum(length) AS DOUBLE) / 1048576, 6) AS mb FROM files
            WHERE regexp_matches(path, '^flat/[^/]*$')
        UNION ALL SELECT 'store', count(*), round(CAST(sum(length) AS DOUBLE) / 1048576, 6) FROM store_files""",
    ),
    "q_files_by_ext": _sql(
        ("files",), f"SELECT regexp_extract(path, '\\.([^.]*)$', 1) AS ext, count(*) AS n_files FROM files WHERE {_IMAGE_FILE} GROUP BY 1"
    ),
    "q_resize_gate": _sql(
        ("files",),
        """SELECT CASE WHEN length = 0 THEN 'skip_empty' WHEN length < 2097152 THEN 'skip_small' ELSE 'resize' END AS gate,
        count(*) AS n_files FROM files GROUP BY 1""",
    ),
    "q_label_join_2022": _joined("SELECT * FROM j"),
    "q_label_join_2021": _sql(
        ("annotations", "images21", "categories", "institutions"),
        """SELECT a.id, a.id AS image_id, replace(i.file_name, 'images/', '') AS filename, split_part(c.name, ' ', 2) AS species,
          split_part(c.name, ' ', 1) AS genus, c.family, n.collection_code AS institution
        FROM annotations a JOIN (SELECT id, max(file_name) AS file_name FROM images21 GROUP BY 1) i ON a.id = i.id
        JOIN categories c ON a.category_id = c.category_id JOIN institutions n ON a.institution_id = n.institution_id""",
    ),
    "q_fk_violations": _sql(
        ("annotations_bad", "images", "categories", "institutions"),
        """SELECT 'images' AS dimension, count(*) AS n_missing FROM annotations_bad WHERE image_id NOT IN (SELECT image_id FROM images)
        UNION ALL SELECT 'categories', count(*) FROM annotations_bad WHERE category_id NOT IN (SELECT category_id FROM categories)
        UNION ALL SELECT 'institutions', count(*) FROM annotations_bad WHERE institution_id NOT IN (SELECT institution_id FROM institutions)""",
    ),
    "q_last_wins": _sql(
        ("dim_updates",),
        """SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY position DESC) AS rn FROM dim_updates) q WHERE rn = 1""",
    ),
    "q_caption": _joined(f"SELECT id, {_CAPTION} AS caption, {_NAME} AS scientific_name FROM j"),
    "q_label_encode": _joined(
        f"""SELECT scientific_name, row_number() OVER (ORDER BY scientific_name) - 1 AS code
        FROM (SELECT DISTINCT {_NAME} AS scientific_name FROM j) q"""
    ),
    "q_split": _joined(f"SELECT id, {_SPLIT} AS split FROM j"),
    "q_preview": _joined("SELECT id, image_id, filename FROM j ORDER BY id LIMIT 5"),
    "q_classify": _log("SELECT attempt_id, outcome FROM ev"),
    "q_link_invalid": _log("SELECT attempt_id, url, content_type FROM ev WHERE status = 200 AND content_type IS DISTINCT FROM 'image/jpeg'"),
    "q_retry_seconds": _log("SELECT attempt_id, round(rest_us / 1000000, 6) AS seconds FROM ev WHERE rest_us IS NOT NULL"),
    "q_host_errors": _log("SELECT host, count(*) AS errors FROM ev WHERE is_error = 1 GROUP BY host"),
    "q_top_hosts": _log("SELECT host, count(*) AS errors FROM ev WHERE is_error = 1 GROUP BY host ORDER BY errors DESC, host LIMIT 10"),
    "q_breaker_state": _log(
        """, b AS (SELECT attempt_id, CAST(coalesce(sum(is_error) OVER (PARTITION BY host ORDER BY ts_us, attempt_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS errors_before FROM ev)
        SELECT attempt_id, errors_before, errors_before >= 50 AS open FROM b"""
    ),
    "q_breaker_summary": _log(
        "SELECT count(*) AS n_broken FROM (SELECT host FROM ev WHERE is_error = 1 GROUP BY host HAVING count(*) >= 50) q"
    ),
    "q_cooldown_observed": _log(
        """SELECT attempt_id, coalesce(ts_us < last_value(ts_us + rest_us IGNORE NULLS) OVER (PARTITION BY host ORDER BY ts_us, attempt_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS blocked FROM ev"""
    ),
    "q_guard_replay": _log("SELECT attempt_id, decision FROM g", _GUARD, recursive=True),
    "q_first_success": _log(
        """SELECT gbif_id, attempt_id FROM (SELECT *, row_number() OVER (PARTITION BY gbif_id ORDER BY seq, attempt_id) AS rn FROM ev WHERE accepted) q
        WHERE rn = 1"""
    ),
    "q_final_state": _log(
        """, f AS (SELECT gbif_id, attempt_id, row_number() OVER (PARTITION BY gbif_id ORDER BY seq, attempt_id) AS rn FROM ev WHERE accepted)
        SELECT CASE WHEN f.attempt_id % 29 <> 0 THEN 'done' ELSE 'failed' END AS state, count(*) AS n_ids
        FROM (SELECT DISTINCT gbif_id FROM ev) e LEFT JOIN f ON f.gbif_id = e.gbif_id AND f.rn = 1 GROUP BY 1"""
    ),
    "q_milestones": _log(
        f""", f AS (SELECT *, row_number() OVER (PARTITION BY gbif_id ORDER BY seq, attempt_id) AS rn FROM ev WHERE accepted)
        SELECT ordinal, gbif_id FROM (SELECT gbif_id, row_number() OVER (ORDER BY ts_us, attempt_id) AS ordinal FROM f WHERE rn = 1) q
        WHERE ordinal % {MILESTONE_EVERY} = 0"""
    ),
    "q_manifest_urls": _sql(("multimedia", "manifests"), "SELECT url, CAST(pos AS INT) AS pos, image_url FROM mu", _MANIFEST_CTE),
    "q_expand_candidates": _sql(("multimedia", "manifests"), "SELECT gbif_id, candidate_url FROM ex", _MANIFEST_CTE),
    "q_candidate_order": _sql(
        ("multimedia", "manifests"),
        """SELECT gbif_id, row_number() OVER (PARTITION BY gbif_id
            ORDER BY md5(CAST(gbif_id AS STRING) || '|' || candidate_url || '|42'), candidate_url) AS pos, candidate_url FROM ex""",
        _MANIFEST_CTE,
    ),
    "q_fit_dims": _sql(
        ("dims",),
        """SELECT image_id, new_w, new_h, (new_w <> w OR new_h <> h OR fmt <> 'JPEG') AS changed FROM (
          SELECT *, CAST(floor(CAST(w AS DOUBLE) * scale) AS INT) AS new_w, CAST(floor(CAST(h AS DOUBLE) * scale) AS INT) AS new_h
          FROM (SELECT *, least(CAST(1024 AS DOUBLE) / CAST(greatest(w, h) AS DOUBLE), CAST(1 AS DOUBLE)) AS scale FROM dims) a) b""",
    ),
    "q_psnr": _sql(
        ("pixels",),
        """SELECT vec_id, round(mse, 6) AS mse, CASE WHEN mse > 0 THEN round(10 * log10(65025 / mse), 6) END AS psnr, mse = 0 AS identical
        FROM (SELECT vec_id, CAST(list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(px, px2)]) AS DOUBLE) / len(px) AS mse FROM pixels) q""",
    ),
}

_REORG = _sql(
    ("files",),
    f"""SELECT path, target, action, action = 'move' AND count(*) OVER (PARTITION BY target) > 1 AS collision FROM (
      SELECT path, CASE WHEN regexp_matches(stem, '^[0-9]+$') THEN concat('store/', substring(stem, 1, 3), '/',
          CASE WHEN length(stem) >= 6 THEN substring(stem, 4, 3) ELSE '000' END, '/', name) END AS target,
        CASE WHEN regexp_matches(stem, '^[0-9]+$') THEN 'move' ELSE 'skip' END AS action
      FROM (SELECT path, regexp_extract(path, '[^/]*$', 0) AS name, {_PLAIN_STEM} AS stem FROM files WHERE {_IMAGE_FILE}) a) b""",
)
ORACLES["q_reorg_plan"] = _REORG
ORACLES["q_reorg_summary"] = f"SELECT action, count(*) AS n_files FROM ({_REORG}) r GROUP BY action"

_ONCE = "SELECT id, 1 AS n_lines FROM (SELECT id FROM done UNION SELECT id FROM bad) u"
# Lanczos weights of eight samples onto five, normalised, and both passes with rounding to bytes.
_LANCZOS = """
t8 AS (SELECT unnest(range(8)) AS s), t5 AS (SELECT unnest(range(5)) AS t),
o8 AS (SELECT t, s, (s + 0.5::DOUBLE - (t + 0.5::DOUBLE) * (8::DOUBLE / 5)) / (8::DOUBLE / 5) AS o FROM t5 CROSS JOIN t8),
w8 AS (SELECT t, s, CASE WHEN abs(o) >= 3 THEN 0 WHEN o = 0 THEN 1 ELSE sin(pi() * o) / (pi() * o) * sin(pi() * o / 3) / (pi() * o / 3) END AS w FROM o8),
n8 AS (SELECT t, s, w / sum(w) OVER (PARTITION BY t) AS w FROM w8),
px8 AS (SELECT vec_id, s AS p, px[s + 1] AS v FROM pixels CROSS JOIN (SELECT unnest(range(64)) AS s) i),
wide AS (SELECT vec_id, p // 8 AS y, t AS x, least(greatest(floor(sum(v * w) + 0.5), 0), 255) AS v
  FROM px8 JOIN n8 ON n8.s = p % 8 GROUP BY ALL),
small AS (SELECT vec_id, t AS y, x, CAST(least(greatest(floor(sum(v * w) + 0.5), 0), 255) AS INT) AS v FROM wide JOIN n8 ON n8.s = y GROUP BY vec_id, t, x)
"""
ORACLES |= {
    "q_training_set": _joined(
        f"""SELECT id, image_id, filename, {_CAPTION} AS caption, {_NAME} AS scientific_name, family, genus, species, code, {_SPLIT} AS split
        FROM (SELECT *, dense_rank() OVER (ORDER BY {_NAME}) - 1 AS code FROM j) q"""
    ),
    "q_scan_tsv": _sql(("multimedia",), "SELECT gbif_id, identifier, country_code FROM multimedia"),
    "q_bundle_explode": _joined("SELECT CAST(image_id AS STRING) AS image_id, filename, species, genus, family, institution FROM j"),
    "q_sink_csv": _joined("SELECT row_number() OVER (ORDER BY id) - 1 AS row_index, * FROM j"),
    "q_sink_jsonl": _sql(("multimedia",), "SELECT * FROM multimedia"),
    "q_checkpoint_append": _ids(_ONCE),
    "q_store_layout": _sql(
        ("pixels",),
        """SELECT gbif_id, substring(id, 1, 3) AS prefix1, CASE WHEN length(id) >= 6 THEN substring(id, 4, 3) ELSE '000' END AS prefix2, content_hex
        FROM (SELECT vec_id * 3 + 1000000 AS gbif_id, CAST(vec_id * 3 + 1000000 AS STRING) AS id, array_to_string([printf('%02X', v) for v in px], '') AS content_hex FROM pixels) q""",
    ),
    "q_image_flatten": _sql(
        ("pixels",),
        """SELECT vec_id, 4 AS height, 4 AS width, 3 AS bands, array_to_string([printf('%02X', (v + (v >> 8)) >> 8) for v in vs], '') AS data_hex
        FROM (SELECT vec_id, [px[4 * (i // 3) + i % 3 + 1] * px[4 * (i // 3) + 4] + 255 * (255 - px[4 * (i // 3) + 4]) + 128 for i in range(48)] AS vs FROM pixels) q""",
    ),
    "q_image_resize": _sql(
        ("pixels",),
        """SELECT vec_id, 5 AS height, 5 AS width, 3 AS bands, string_agg(repeat(printf('%02X', v), 3), '' ORDER BY y, x) AS data_hex FROM small GROUP BY vec_id""",
        _LANCZOS,
    ),
    "q_image_scan": """SELECT CAST(vec_id AS STRING) || '.png' AS name, vec_id % 50 = 0 AS empty, CASE WHEN vec_id % 50 > 1 THEN 8 END AS height,
        CASE WHEN vec_id % 50 > 1 THEN 8 END AS width, vec_id % 50 > 1 AS readable FROM embeddings""",
    "st_guard": ORACLES["q_guard_replay"],
    "st_host_errors": ORACLES["q_host_errors"],
    "st_checkpoint": _ids(_ONCE),
    "st_milestones": ORACLES["q_milestones"],
}
