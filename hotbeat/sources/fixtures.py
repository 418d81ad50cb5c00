"""Stand-in incident table over the driver's ``events`` parquet.

The same SQL text runs in Spark and in DuckDB (the oracle); only the JSON
extraction and the string type name differ.  The Spark side is a single
projection over the parquet scan, so Catalyst prunes ``events`` to the
columns a query needs and pushes filters on ``event_id``/``ts`` down.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

INCIDENTS_TEMPLATE = """
SELECT event_id AS incident_id,
       CAST(ts AS DATE) AS occ_date,
       CAST(ts AS DATE) + CAST({k} % 14 AS INT) AS rptd_date,
       LPAD(CAST(hour(ts)*100 + minute(ts) AS {STR}), 4, '0') AS time_occ,
       CAST(user_id % 21 + 1 AS INT) AS area,
       CAST((user_id * 13 + {k}) % 160 + 110 AS INT) AS crm_cd,
       CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE {k} END AS INT) AS vict_age,
       CASE event_id % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X'
                         WHEN 3 THEN 'H' WHEN 4 THEN '-' ELSE NULL END AS vict_sex,
       event_type AS category,
       CASE WHEN event_id % 97 = 0 THEN 0.0E0
            ELSE 34.0E0 + (user_id % 15) * 0.004E0 + ({k} % 10) * 0.0002E0 END AS lat,
       CASE WHEN event_id % 97 = 0 THEN 0.0E0
            ELSE -118.4E0 + (user_id % 11) * 0.005E0 + ({k} % 7) * 0.0003E0 END AS lon,
       value AS amount
FROM events
"""

SPARK_K = "CAST(get_json_object(props,'$.k') AS BIGINT)"
DUCK_K = "CAST(json_extract_string(props,'$.k') AS BIGINT)"

INCIDENTS_SPARK_SQL = INCIDENTS_TEMPLATE.format(k=SPARK_K, STR="STRING")
INCIDENTS_DUCK_SQL = INCIDENTS_TEMPLATE.format(k=DUCK_K, STR="VARCHAR")

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Spark side: the JSON field is parsed once per row in an inner projection
# (the optimizer keeps it there because it is referenced several times),
# instead of once per derived column; the result is the same view.
INCIDENTS_SPARK_ONCE_SQL = INCIDENTS_TEMPLATE.format(k="k", STR="STRING").replace(
    "FROM events", f"FROM (SELECT *, {SPARK_K} AS k FROM events) e")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``incidents`` stand-in view as a DataFrame (lazy, prunable)."""
    ev = table(spark, sf_dir, "events")
    # A per-call view name keeps concurrent sessions/sf dirs apart.
    name = "events_" + str(abs(hash(os.path.abspath(sf_dir))))
    ev.createOrReplaceTempView(name)
    return spark.sql(INCIDENTS_SPARK_ONCE_SQL.replace("FROM events", f"FROM {name}"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")
