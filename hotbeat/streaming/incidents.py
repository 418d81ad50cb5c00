"""The stateless cleaning + feature chain on a Structured Streaming source.

The source workflow has no streaming; this module only shows that P18/P19
are plain column expressions, so the same functions run unchanged on a
stream of new incident files (micro-batches, exactly-once file sink via the
checkpoint).  Duplicate removal is left out: without a watermark it would
keep unbounded state.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from hotbeat.plans.prepare import enrich, prepare
from hotbeat.session import scratch_path
from hotbeat.sources.fixtures import INCIDENTS_SPARK_SQL


def incident_stream(spark: SparkSession, source_dir: str, file_glob: str = "events.parquet"):
    """Stream of incidents from event parquet files arriving in ``source_dir``."""
    schema = spark.read.parquet(f"{source_dir}/{file_glob}").schema
    ev = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
          .option("maxFilesPerTrigger", 100).parquet(source_dir))
    ev.createOrReplaceTempView("events_stream")
    return spark.sql(INCIDENTS_SPARK_SQL.replace("FROM events", "FROM events_stream"))


def enrich_stream(spark: SparkSession, source_dir: str, path: str, checkpoint: str | None = None,
                  query_name: str = "enriched_incidents") -> StreamingQuery:
    """Start the enrich chain as a streaming query (``availableNow`` trigger) into Parquet files under ``path``."""
    df = enrich(prepare(incident_stream(spark, source_dir), dedupe_rows=False))
    return (df.writeStream.outputMode("append").queryName(query_name).format("parquet")
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{query_name}"))
            .trigger(availableNow=True).start(path))
