"""The cleaning chain (P18) and the feature chain.

Both are lazy projections/filters composed with ``DataFrame.transform``;
the only shuffle is the duplicate removal, whose partial aggregation
collapses repeated rows map-side.  Filters on coordinates and age are pushed
below the de-duplication (and into the parquet scan) by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat import fixed
from hotbeat.functions import calendar as cal
from hotbeat.functions import codes
from hotbeat.operators import clean


def prepare(df: DataFrame, *, require_age: bool = True, dedupe_rows: bool = True, age: str = "vict_age",
            sex: str = "vict_sex", lat: str = "lat", lon: str = "lon",
            required: tuple[str, ...] = ("crm_cd", "lat", "lon")) -> DataFrame:
    """Dedupe -> clean age -> (drop unknown age) -> fill/merge sex ->
    fill text -> drop rows missing required fields -> drop (0,0).

    ``dedupe_rows=False`` keeps the chain stateless (for streams, where
    duplicate removal would need unbounded state without a watermark).
    """
    if dedupe_rows:
        df = clean.dedupe(df)
    df = clean.clean_age(df, age)
    if require_age:
        df = clean.drop_null(df, [age])
    df = clean.fill_defaults(df, {sex: fixed.SEX_FILL})
    df = clean.normalise_codes(df, sex, fixed.SEX_MERGE)
    df = clean.fill_text(df)
    df = clean.drop_null(df, [c for c in required if c in df.columns])
    return clean.valid_location(df, lat, lon)


def enrich(df: DataFrame, *, drop: tuple[str, ...] = (), date: str = "occ_date",
           clock: str = "time_occ", age: str = "vict_age", code: str = "crm_cd",
           descent: str | None = None) -> DataFrame:
    """Drop redundant columns, add calendar, shift, age band, category.

    Adds ``occ_ts``, ``hour``, ``time_slot``, ``occ_year``, ``occ_month``,
    ``occ_weekday`` (1 = Sunday), ``occ_day`` (day of month), ``age_group``,
    ``crime_category`` and, when ``descent`` is given, ``descent_label``.
    ``time_occ`` becomes ``HH:mm`` text.
    """
    df = clean.drop_columns(df, drop)
    df = df.withColumn(clock, cal.format_clock(F.col(clock)))
    df = df.withColumn("occ_ts", cal.occurred_at(date, clock))
    df = (df.withColumn("hour", cal.hour_of("occ_ts"))
            .withColumn("time_slot", cal.time_slot("hour"))
            .withColumn("occ_year", cal.year_of(date))
            .withColumn("occ_month", cal.month_of(date))
            .withColumn("occ_weekday", cal.weekday(date))
            .withColumn("occ_day", cal.day_of_month(date))
            .withColumn("age_group", codes.age_group(age)))
    if descent:
        df = df.withColumn("descent_label", codes.descent_label(descent))
    return codes.category_of(df, code)


def prepared_incidents(inc: DataFrame, **kw) -> DataFrame:
    return enrich(prepare(inc, **kw))
