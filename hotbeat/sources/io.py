"""Sources and sinks.

Scans use declared schemas (no inference pass).  Snapshots are parquet
partitioned by a low-cardinality key (``area``) so later filters prune
whole directories.  All written paths live under the shared checkpoint
folder (``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hotbeat.session import scratch_path

# Schema of the stand-in incident table (snake_case names; see FIXTURES.md).
INCIDENT_SCHEMA = T.StructType([
    T.StructField("incident_id", T.LongType()),
    T.StructField("occ_date", T.DateType()),
    T.StructField("rptd_date", T.DateType()),
    T.StructField("time_occ", T.StringType()),
    T.StructField("area", T.IntegerType()),
    T.StructField("crm_cd", T.IntegerType()),
    T.StructField("vict_age", T.IntegerType()),
    T.StructField("vict_sex", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
])

# Schema of the raw 28-column public extract, for ``read_raw_incidents``.
RAW_SCHEMA = T.StructType([
    T.StructField("DR_NO", T.LongType()), T.StructField("Date Rptd", T.StringType()),
    T.StructField("DATE OCC", T.StringType()), T.StructField("TIME OCC", T.IntegerType()),
    T.StructField("AREA", T.IntegerType()), T.StructField("AREA NAME", T.StringType()),
    T.StructField("Rpt Dist No", T.IntegerType()), T.StructField("Part 1-2", T.IntegerType()),
    T.StructField("Crm Cd", T.IntegerType()), T.StructField("Crm Cd Desc", T.StringType()),
    T.StructField("Mocodes", T.StringType()), T.StructField("Vict Age", T.IntegerType()),
    T.StructField("Vict Sex", T.StringType()), T.StructField("Vict Descent", T.StringType()),
    T.StructField("Premis Cd", T.IntegerType()), T.StructField("Premis Desc", T.StringType()),
    T.StructField("Weapon Used Cd", T.IntegerType()), T.StructField("Weapon Desc", T.StringType()),
    T.StructField("Status", T.StringType()), T.StructField("Status Desc", T.StringType()),
    T.StructField("Crm Cd 1", T.IntegerType()), T.StructField("Crm Cd 2", T.IntegerType()),
    T.StructField("Crm Cd 3", T.IntegerType()), T.StructField("Crm Cd 4", T.IntegerType()),
    T.StructField("LOCATION", T.StringType()), T.StructField("Cross Street", T.StringType()),
    T.StructField("LAT", T.DoubleType()), T.StructField("LON", T.DoubleType()),
])

# Raw names -> snake_case, so later code never depends on case-insensitive
# name resolution (``Date OCC`` vs ``DATE OCC``, Q4).
RAW_RENAMES = {f.name: f.name.lower().replace(" ", "_").replace("-", "_") for f in RAW_SCHEMA.fields}


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def read_incidents(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA,
                   header: bool = True) -> DataFrame:
    """CSV scan with a declared schema; malformed fields become null."""
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .csv(path))


def scan_with_rejects(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA,
                      header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a reject table: (rows that fit the schema, rejects).

    A line is rejected if a field does not parse as its column's type or if it has too few or too many
    fields.  Rejects are (line, file, bad_columns): the raw text, where it came from, and the columns, comma-joined
    in schema order, whose text is there but not a value (empty if only the number of fields is wrong).
    The scan runs once, into a table of the shared folder; both results read that.
    """
    raw = "_corrupt_record"
    wide = T.StructType([*schema.fields, T.StructField(raw, T.StringType())])
    rows = (spark.read.schema(wide).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", raw).csv(path).withColumn("_file", F.input_file_name()))
    kept = scratch_path(spark, "scanned")
    rows.write.parquet(kept)
    rows = spark.read.parquet(kept)
    names = [f.name for f in schema.fields]
    as_text = ", ".join(f"`{n}` STRING" for n in names)
    bad = rows.where(F.col(raw).isNotNull()).withColumn("_text", F.from_csv(raw, as_text))
    wrong = F.array(*[F.when(F.col("_text")[n].isNotNull() & F.col(f"`{n}`").isNull(), F.lit(n)) for n in names])
    rejects = bad.select(F.col(raw).alias("line"), F.col("_file").alias("file"), F.array_join(F.array_compact(wrong), ",").alias("bad_columns"))
    return rows.where(F.col(raw).isNull()).select(*[F.col(f"`{n}`") for n in names]), rejects


def reject_counts(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """(outcome, n): ``ok``, or the bad columns of the rejects (``shape`` where the number of fields is wrong)."""
    outcome = F.when(F.col("bad_columns") == "", "shape").otherwise(F.col("bad_columns"))
    return (good.agg(F.count("*").alias("n")).select(F.lit("ok").alias("outcome"), "n")
            .unionByName(rejects.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))))


def read_raw_incidents(spark: SparkSession, path: str) -> DataFrame:
    """S1 for the raw public extract: declared 28-column schema, snake_case names."""
    df = read_incidents(spark, path, RAW_SCHEMA)
    return df.select([F.col(f"`{k}`").alias(v) for k, v in RAW_RENAMES.items()])


def read_category_map(spark: SparkSession, path: str, code_col: str = "crm_cd",
                      label_col: str = "crime_category") -> DataFrame:
    """Lookup CSV, two columns kept, label trimmed."""
    schema = T.StructType([T.StructField(code_col, T.IntegerType()),
                           T.StructField(label_col, T.StringType())])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(code_col, F.trim(label_col).alias(label_col)).filter(F.col(code_col).isNotNull())


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet snapshot, optionally partitioned (enables partition pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    """Spark ML model / pipeline persistence."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def point_layer(df: DataFrame, layer: str = "cluster", label_cols: list[str] = ("category",),
                lat: str = "lat", lon: str = "lon", id_col: str = "incident_id") -> DataFrame:
    """Rows that feed a heat / marker map layer (drawing is out of scope)."""
    label = F.concat_ws(" ", *[F.col(c).cast("string") for c in label_cols])
    return df.select(id_col, lat, lon, F.col(layer).alias("layer"), label.alias("label"))


def write_point_layer(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def describe_table(df: DataFrame) -> DataFrame:
    """(column_name, data_type, ordinal, n_rows) from the schema plus one count.

    The schema part is a literal ``stack`` over the one-row count aggregate,
    so there is a single job and no join.
    """
    fields = df.schema.fields
    body = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', {i + 1}" for i, f in enumerate(fields))
    one = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return one.selectExpr(f"stack({len(fields)}, {body}) AS (column_name, data_type, ordinal)", "n_rows")


def head_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows (the feature is a preview, so the limit stays)."""
    return df.limit(n)


def to_raw_layout(inc: DataFrame) -> DataFrame:
    """Incident rows in the public extract's 28-column text layout (for round trips).

    Dates become ``MM/dd/yyyy hh:mm:ss a`` text, the clock an integer without
    leading zeros; columns the stand-in view lacks are null.
    """
    txt = "MM/dd/yyyy hh:mm:ss a"
    known = {
        "DR_NO": F.col("incident_id"),
        "Date Rptd": F.date_format(F.col("rptd_date").cast("timestamp"), txt),
        "DATE OCC": F.date_format(F.col("occ_date").cast("timestamp"), txt),
        "TIME OCC": F.col("time_occ").try_cast("int"),
        "AREA": F.col("area"), "Crm Cd": F.col("crm_cd"), "Crm Cd Desc": F.col("category"),
        "Vict Age": F.col("vict_age"), "Vict Sex": F.col("vict_sex"),
        "LAT": F.col("lat"), "LON": F.col("lon"),
    }
    return inc.select(*[(known[f.name] if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in RAW_SCHEMA.fields])


def from_raw(raw: DataFrame) -> DataFrame:
    """Raw snake_case extract -> the incident schema used by every operator.

    Text dates go through ``try_to_timestamp`` (junk -> null, Q11) and the
    integer clock keeps its 4-digit text form; DATE OCC is never overwritten
    by the day of month (Q4).
    """
    from hotbeat.functions.calendar import parse_date
    return raw.select(
        F.col("dr_no").alias("incident_id"), parse_date("date_occ").alias("occ_date"),
        parse_date("date_rptd").alias("rptd_date"),
        F.lpad(F.col("time_occ").cast("string"), 4, "0").alias("time_occ"),
        F.col("area"), F.col("crm_cd"), F.col("vict_age"), F.col("vict_sex"),
        F.col("crm_cd_desc").alias("category"), F.col("lat"), F.col("lon"),
        F.lit(None).cast("double").alias("amount"))
