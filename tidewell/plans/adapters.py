"""Views that shape the test tables like annotation, detection, log and measurement tables.

Each is SQL that Spark and other engines read alike; tables stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidewell.operators.ordered import dealt

ADAPTERS = {
    "keyframes": """SELECT l_orderkey AS stem, l_orderkey % 3 AS track, CAST(l_linenumber * 4 AS INT) AS frame,
        l_partkey * 1000000 + l_suppkey AS kf_pos, l_quantity AS x, (l_discount + 0.0) * 100 AS y, (l_tax + 0.0) * 100 + 1 AS w,
        l_quantity / 2 AS h, l_returnflag <> 'R' AS enabled FROM {lineitem}""",
    "boxes": """SELECT o_orderpriority AS site, l_orderkey AS stem, l_linenumber AS frame, CAST(l_suppkey % 5 AS INT) AS class_id,
        l_discount + 0.0 AS w, l_tax + 0.0 AS h FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "norm_boxes": """SELECT l_orderkey AS stem, l_linenumber AS frame, l_partkey AS a, l_suppkey AS b, l_returnflag AS flag, l_quantity / 51 AS xc,
        (l_discount + 0.0) * 9 AS yc, (l_tax + 0.0) + 0.05 AS w, l_quantity / 100 AS h FROM {lineitem}""",
    "detections": """SELECT CAST(CAST(ts AS DATE) AS STRING) AS clip, user_id % 7 AS track,
        row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS frame, event_type AS cls, value AS x, value / 1000 AS conf FROM {events}""",
    "logs": """SELECT user_id AS device, ts, event_id AS pos, event_type = 'signup' AS restart, event_type IN ('click', 'view') AS healthy FROM {events}""",
    "motion": """SELECT user_id AS camera, user_id % 3 AS site, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame,
        value > 50 AS has_motion FROM {events}""",
    "counts_gt": """SELECT l_orderkey % 200 AS filename, CASE WHEN l_linestatus = 'O' THEN 'l' ELSE 'r' END AS direction, l_returnflag AS species,
        count(*) AS n FROM {lineitem} GROUP BY 1, 2, 3""",
    "counts_pred": """SELECT l_orderkey % 200 AS filename, CASE WHEN l_linestatus = 'O' THEN 'l' ELSE 'r' END AS direction, l_returnflag AS species,
        count(*) AS n FROM {lineitem} WHERE l_discount < 0.05 GROUP BY 1, 2, 3""",
    "stems": """SELECT s_suppkey, concat('ORG-', lower(replace(n_name, ' ', '')), '-cam-', s_suppkey, '_20250714_', lpad(CAST(s_suppkey % 240000 AS STRING), 6, '0'), '_M') AS stem
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "conditions": """SELECT p_partkey, p_brand AS brand, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size,
        p_type AS kind FROM {part}""",
    "manifest": """SELECT doc_id, source AS site, concat('vid', CAST(doc_id % 97 AS STRING), '/frame_', lpad(CAST(doc_id AS STRING), 6, '0'), '.txt') AS relpath,
        CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'val' ELSE 'train' END AS split FROM {documents}""",
    "measurements": "SELECT ts, event_id, user_id % 4 AS region, value * 1e6 AS bits FROM {events}",
    "weather": "SELECT date_trunc('day', ts) AS day, CAST(count(*) AS DOUBLE) / 7 AS rain FROM {events} WHERE event_type = 'purchase' GROUP BY 1",
    "clips": """SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS clip, o_totalprice / 1000 AS duration FROM {orders}""",
    "trials": """SELECT l_suppkey AS trial, l_orderkey * 10000000 + l_partkey AS epoch, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax + 0.0 END AS map50,
        CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_discount + 0.0 END AS fitness FROM {lineitem}""",
    "videos": "SELECT o_orderkey AS stem, 10 + o_orderkey % 40 AS n_frames FROM {orders}",
    "positives": "SELECT DISTINCT l_orderkey AS stem, l_linenumber AS frame FROM {lineitem}",
}

_TABLE = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter over the tables of a folder."""
    text = ADAPTERS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_TABLE.findall(text))}
    if name == "boxes":  # joined, and mostly grouped, by order
        lines = tables["lineitem"]
        tables |= {"lineitem": dealt(lines, lines, "l_orderkey"), "orders": dealt(tables["orders"], lines, "o_orderkey")}
    return spark.sql(text, **tables)


def sql(text: str) -> str:
    """SQL in which ``@name`` stands for an adapter, as plain SQL over the tables."""
    return re.sub(r"@(\w+)", lambda m: f"({_TABLE.sub(lambda t: t[1], ADAPTERS[m[1]])})", text)
