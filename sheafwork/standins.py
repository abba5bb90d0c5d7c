"""Input views over the given tables.

The text of each view is valid in Spark SQL and in the checking engine, so both sides read the same
input. ``{table}`` stands for one of the given Parquet tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "multimedia": r"""
SELECT ((l.l_orderkey*8 + l.l_linenumber)*20000 + l.l_partkey)*1000 + l.l_suppkey AS row_id,
       CASE WHEN l.l_partkey % 997 = 0 THEN NULL ELSE l.l_orderkey*37 END AS gbif_id,
       CASE WHEN l.l_partkey % 101 = 0 THEN NULL
            ELSE concat(CASE WHEN l.l_partkey % 2 = 0 THEN 'http' ELSE 'https' END, '://host',
                        CAST(l.l_suppkey % 40 AS STRING), '.example.org',
                        CASE WHEN l.l_suppkey % 3 = 0 THEN ':8080' ELSE '' END,
                        CASE WHEN l.l_partkey % 10 = 0 THEN concat('/iiif/', CAST(l.l_partkey AS STRING), '/manifest')
                             WHEN l.l_partkey % 10 = 1 THEN concat('/iiif/', CAST(l.l_partkey AS STRING), '.json')
                             ELSE concat('/media/', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING), '.jpg') END)
       END AS identifier,
       n.n_name AS country_code
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
""",
    "processed_ids": r"""
SELECT concat(' ', CAST(o_orderkey*37 AS STRING), ' ') AS line FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL SELECT CAST(o_orderkey*37 AS STRING) FROM {orders} WHERE o_orderstatus = 'F' AND o_orderkey % 11 = 0
UNION ALL SELECT '' FROM {region}
""",
    "failed_ids": r"""
SELECT CAST(o_orderkey*37 AS STRING) AS line FROM {orders} WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderkey % 50 = 0)
""",
    "prior_a": r"""
SELECT o_orderkey*37 AS gbif_id FROM {orders} WHERE o_orderdate < TIMESTAMP '1995-07-01 00:00:00'
""",
    "prior_b": r"""
SELECT o_orderkey*37 AS gbif_id FROM {orders} WHERE o_totalprice > 450000
""",
    "files": r"""
SELECT concat(CASE d.r_regionkey WHEN 0 THEN 'flat/' ELSE 'flat/copy/' END,
              CASE WHEN o.o_orderkey % 13 = 0 THEN concat('IMG_', CAST(o.o_orderkey AS STRING)) ELSE CAST(o.o_orderkey*37 AS STRING) END,
              CASE o.o_orderkey % 7 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPEG' WHEN 2 THEN '.png' WHEN 3 THEN '.tif' WHEN 4 THEN '.TIFF' WHEN 5 THEN '.Jpg' ELSE '.txt' END) AS path,
       CASE WHEN o.o_orderkey % 17 = 0 THEN 0 ELSE CAST(floor(o.o_totalprice * 10) AS BIGINT) END AS length
FROM {orders} o JOIN {region} d ON d.r_regionkey = 0 OR (d.r_regionkey = 1 AND o.o_orderkey % 33 = 0)
""",
    "store_files": r"""
SELECT concat('store/', substring(sid, 1, 3), '/', CASE WHEN length(sid) >= 6 THEN substring(sid, 4, 3) ELSE '000' END, '/', sid, '.jpg') AS path,
       CASE WHEN o_orderkey % 5 = 0 THEN 10480 + o_orderkey % 12 ELSE CAST(floor(o_totalprice * 10) AS BIGINT) END AS length
FROM (SELECT o.*, CAST(o_orderkey*37 AS STRING) AS sid FROM {orders} o) q WHERE o_orderkey % 4 = 0
""",
    "attempts": r"""
SELECT event_id AS attempt_id, CAST(floor(event_id / 4) AS BIGINT)*37 AS gbif_id, CAST(event_id % 4 AS INT) AS seq,
       concat('http://host', CAST(user_id % 20 AS STRING), '.example.org/', CAST(event_id AS STRING), '.jpg') AS url, ts,
       CASE WHEN event_type = 'purchase' OR event_type = 'view' OR event_type = 'click' THEN 200 WHEN event_type = 'signup' THEN 404
            WHEN k < 40 THEN 429 WHEN k < 70 THEN 503 ELSE NULL END AS status,
       CASE WHEN event_type = 'error' AND k >= 70 AND k < 85 THEN 'timeout' WHEN event_type = 'error' AND k >= 85 THEN 'exception' ELSE NULL END AS error_kind,
       CASE WHEN event_type = 'purchase' THEN 'image/jpeg' WHEN event_type = 'view' THEN 'Text/HTML; charset=utf-8'
            WHEN event_type = 'click' AND k % 2 = 0 THEN 'image/png' WHEN event_type = 'signup' THEN 'application/xml' ELSE NULL END AS content_type,
       CASE WHEN event_type = 'error' AND k < 15 THEN CAST(k * 60 AS STRING)
            WHEN event_type = 'error' AND k < 25 THEN concat('Mon, 15 Jan 2024 ', CASE WHEN k % 2 = 0 THEN '07' ELSE '19' END, ':28:00 GMT')
            WHEN event_type = 'error' AND k < 30 THEN 'soon' ELSE NULL END AS retry_after
FROM (SELECT e.*, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events} e) q
""",
    "annotations": r"""
SELECT ((l_orderkey*8 + l_linenumber)*20000 + l_partkey)*1000 + l_suppkey AS id, l_orderkey AS image_id, l_partkey AS category_id, l_suppkey AS institution_id FROM {lineitem}
""",
    "images": r"""
SELECT o_orderkey AS image_id, concat('images/', CAST(o_orderkey AS STRING), '.jpg') AS file_name FROM {orders}
""",
    "images21": r"""
SELECT ((l_orderkey*8 + l_linenumber)*20000 + l_partkey)*1000 + l_suppkey AS id, concat('images/', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING), '.jpg') AS file_name FROM {lineitem}
""",
    "categories": r"""
SELECT p_partkey AS category_id, p_type AS family, p_name AS name, split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS species FROM {part}
""",
    "institutions": r"""
SELECT s_suppkey AS institution_id, s_name AS collection_code FROM {supplier}
""",
    "dims": r"""
SELECT ((l_orderkey*8 + l_linenumber)*20000 + l_partkey)*1000 + l_suppkey AS image_id, CAST(100 + floor(l_extendedprice) % 2500 AS INT) AS w, CAST(100 + (l_partkey * 7) % 1900 AS INT) AS h,
       CASE WHEN l_linenumber % 4 = 0 THEN 'PNG' ELSE 'JPEG' END AS fmt FROM {lineitem}
""",
    "annotations_bad": r"""
SELECT id, CASE WHEN image_id % 211 = 0 THEN -1 ELSE image_id END AS image_id, CASE WHEN category_id % 307 = 0 THEN -1 ELSE category_id END AS category_id,
       institution_id FROM annotations
""",
    "dim_updates": r"""
SELECT event_id AS position, user_id AS key, event_type AS value FROM {events}
""",
    "manifests": r"""
SELECT url, CASE WHEN pid % 30 = 0 THEN 'not json'
                 WHEN pid % 30 = 20 THEN '{{}}'
                 ELSE concat('{{"items":[{{"type":"', CASE WHEN pid % 30 = 11 THEN 'Range' ELSE 'Canvas' END,
                             '","items":[{{"type":"AnnotationPage","items":[{{"body":{{"service":[{{"id":"http://iiif.example.org/', CAST(pid AS STRING), '"}}',
                             CASE WHEN pid % 30 = 10 THEN concat(',{{"id":"http://iiif.example.org/', CAST(pid AS STRING), 'b"}}') ELSE '' END,
                             ']}}}}]}}]}}]}}') END AS body
FROM (SELECT DISTINCT identifier AS url, CAST(regexp_extract(identifier, '/iiif/([0-9]+)', 1) AS BIGINT) AS pid
      FROM multimedia WHERE identifier LIKE '%/iiif/%') q
""",
}

# Where the two engines need, or are better served by, a text of their own. The folder view is a
# union here, not a join on an OR condition, so that no nested-loop join is planned.
_FILE_ROW = """
SELECT concat('FOLDER', CASE WHEN o_orderkey % 13 = 0 THEN concat('IMG_', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey*37 AS STRING) END,
              CASE o_orderkey % 7 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPEG' WHEN 2 THEN '.png' WHEN 3 THEN '.tif' WHEN 4 THEN '.TIFF' WHEN 5 THEN '.Jpg' ELSE '.txt' END) AS path,
       CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE CAST(floor(o_totalprice * 10) AS BIGINT) END AS length
FROM {orders}
"""
_SPARK_ONLY = {
    "files": _FILE_ROW.replace("FOLDER", "flat/")
    + "UNION ALL"
    + _FILE_ROW.replace("FOLDER", "flat/copy/")
    + "WHERE o_orderkey % 33 = 0",
    "pixels": """
SELECT vec_id, transform(embedding, v -> CAST(floor((CAST(v AS DOUBLE) + 1) * 127.5) AS INT)) AS px,
       transform(embedding, v -> CAST(floor(floor((CAST(v AS DOUBLE) + 1) * 127.5) / (1 + vec_id % 9)) * (1 + vec_id % 9) AS INT)) AS px2
FROM {embeddings}
""",
}
VIEWS["pixels"] = """
SELECT vec_id, [CAST(floor((CAST(v AS DOUBLE) + 1) * 127.5) AS INT) for v in embedding] AS px,
       [CAST(floor(floor((CAST(v AS DOUBLE) + 1) * 127.5) / (1 + vec_id % 9)) * (1 + vec_id % 9) AS INT) for v in embedding] AS px2
FROM {embeddings}
"""

# Views that read another view.
_READS = {"annotations_bad": ["annotations"], "manifests": ["multimedia"]}


def _tables(text: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)))


def _statement(name: str, text: str) -> str:
    needed = _READS.get(name, [])
    clauses = ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    return f"WITH {clauses} {text}" if clauses else text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view over the Parquet tables in ``sf_dir``."""
    text = _statement(name, _SPARK_ONLY.get(name, VIEWS[name]))
    tables = {t: table(spark, sf_dir, t) for t in _tables(text)}
    return spark.sql(text, **tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def check_clauses(*names: str) -> str:
    """``WITH`` clauses for the checking engine: the named views and what they read."""
    ordered: list[str] = []
    for name in names:
        for needed in [*_READS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    plain = {n: VIEWS[n].format(**{t: t for t in _tables(VIEWS[n])}) for n in ordered}
    return ", ".join(f"{n} AS ({text})" for n, text in plain.items())
