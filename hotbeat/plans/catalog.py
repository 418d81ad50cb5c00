"""Registered queries: one Spark plan per operator, plus its DuckDB oracle.

``QUERIES[key](spark, sf_dir) -> DataFrame`` and ``ORACLE[key] -> SQL``.
Every query reads the driver's tables (through the ``incidents`` stand-in
view or ``orders``) over their whole extent.  Floating outputs are rounded
to 6 places in both engines; every computed column is aliased identically.
Keys without an oracle entry are checked by invariants in ``tests/``.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotbeat import fixed
from hotbeat.functions import calendar as cal
from hotbeat.functions import codes
from hotbeat.functions.geo import geo_km, sphere_km_sql
from hotbeat.operators import clean, profile
from hotbeat.plans.oracle_base import AGE_GROUP_SQL, CLOCK_SQL, with_base
from hotbeat.plans.prepare import enrich, prepare
from hotbeat.session import cut_lineage
from hotbeat.sources import fixtures, io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def inc(spark, sf):
    return fixtures.incidents(spark, sf)


def prep(spark, sf):
    return prepare(inc(spark, sf))


def enr(spark, sf):
    return enrich(prepare(inc(spark, sf)))


# A descent code derived from the data (the stand-in view has none): 19 known
# letters, every 20th row null.
DESCENT_SPARK = ("CASE WHEN incident_id % 20 = 19 THEN NULL "
                 "ELSE substr('ABCDFGHIJKLOPSUVWXZ', CAST(incident_id % 20 AS INT) + 1, 1) END")
DESCENT_DUCK = DESCENT_SPARK

# ---------------------------------------------------------------- sources S*


@register("s1_csv_scan", with_base("SELECT * FROM incidents"))
def s1_csv_scan(spark, sf):
    path = io.write_csv(inc(spark, sf), io.scratch(spark, "incidents_csv"))
    return io.read_incidents(spark, path)


@register("s1_reject_counts", with_base(
    "SELECT CASE incident_id % 10 WHEN 3 THEN 'vict_age' WHEN 7 THEN 'lat,lon' ELSE 'ok' END AS outcome, count(*) AS n "
    "FROM incidents GROUP BY 1"))
def s1_reject_counts(spark, sf):
    """Lines of a CSV extract by what is wrong with them; some fields of the extract hold text that is no number."""
    d = inc(spark, sf)
    spoilt = lambda c, k, text: F.when(F.col("incident_id") % 10 == k, F.lit(text)).otherwise(F.col(c).cast("string")).alias(c)
    d = d.select(*[spoilt(c, 3, "unknown") if c == "vict_age" else spoilt(c, 7, "n/a") if c in ("lat", "lon") else F.col(c) for c in d.columns])
    return io.reject_counts(*io.scan_with_rejects(spark, io.write_csv(d, io.scratch(spark, "spoilt_csv"))))


@register("s2_lookup_csv_join", with_base(
    "SELECT cat.crime_category, count(*) AS n FROM incidents JOIN "
    + codes.category_values_sql() + " ON incidents.crm_cd = cat.crm_cd GROUP BY cat.crime_category"))
def s2_lookup_csv_join(spark, sf):
    path = io.write_csv(codes.category_df(spark), io.scratch(spark, "codes_csv"))
    lookup = io.read_category_map(spark, path)
    j = codes.category_inner(inc(spark, sf), lookup=lookup)
    return profile.counts_by(j, "crime_category")


@register("s3_dictionary_usage", with_base(
    "SELECT cat.crm_cd, cat.crime_category, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM "
    + codes.category_values_sql() +
    " LEFT JOIN (SELECT crm_cd, count(*) AS n FROM incidents GROUP BY crm_cd) c ON c.crm_cd = cat.crm_cd"))
def s3_dictionary_usage(spark, sf):
    counts = profile.counts_by(inc(spark, sf), "crm_cd")
    d = codes.category_df(spark)
    return (d.join(counts, "crm_cd", "left")
             .select("crm_cd", "crime_category", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


@register("s4_snapshot_partition_prune", with_base(
    "SELECT time_slot, count(*) AS n FROM enriched WHERE area = 3 GROUP BY time_slot"))
def s4_snapshot_partition_prune(spark, sf):
    path = io.save_snapshot(enr(spark, sf).drop("occ_ts"), io.scratch(spark, "enriched"), ["area"])
    snap = io.load_snapshot(spark, path).filter(F.col("area") == 3)
    return profile.counts_by(snap, "time_slot")


@register("s6_point_layer", with_base(
    "SELECT incident_id, lat, lon, time_slot AS layer, "
    "category || ' ' || time_occ AS label FROM enriched"))
def s6_point_layer(spark, sf):
    return io.point_layer(enr(spark, sf), layer="time_slot", label_cols=["category", "time_occ"])


@register("s7_describe", with_base(
    "SELECT d.column_name, d.data_type, d.ordinal, (SELECT count(*) FROM incidents) AS n_rows FROM (VALUES "
    "('incident_id','bigint',1),('occ_date','date',2),('rptd_date','date',3),('time_occ','string',4),"
    "('area','int',5),('crm_cd','int',6),('vict_age','int',7),('vict_sex','string',8),"
    "('category','string',9),('lat','double',10),('lon','double',11),('amount','double',12)"
    ") AS d(column_name, data_type, ordinal)"))
def s7_describe(spark, sf):
    return io.describe_table(inc(spark, sf))


# ---------------------------------------------------------------- cleaning P*

P_COLS = "area, crm_cd, vict_sex, category"


@register("p1_duplicate_count", with_base(
    f"SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicates, count(*) AS distinct_rows "
    f"FROM (SELECT count(*) AS n FROM incidents GROUP BY {P_COLS}) g"))
def p1_duplicate_count(spark, sf):
    return clean.duplicate_count(inc(spark, sf).select("area", "crm_cd", "vict_sex", "category"))


@register("p2_dedupe", with_base(f"SELECT DISTINCT {P_COLS} FROM incidents"))
def p2_dedupe(spark, sf):
    return clean.dedupe(inc(spark, sf).select("area", "crm_cd", "vict_sex", "category"))


INC_COLS = ["incident_id", "occ_date", "rptd_date", "time_occ", "area", "crm_cd", "vict_age",
            "vict_sex", "category", "lat", "lon", "amount"]


@register("p3_null_profile", with_base(
    "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in INC_COLS) + " FROM incidents"))
def p3_null_profile(spark, sf):
    return clean.null_profile(inc(spark, sf))


@register("p4_null_ratio", with_base(
    "SELECT column_name, null_count, round(null_count / n, 6) AS null_ratio FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count, count(*) AS n "
                         f"FROM incidents" for c in INC_COLS) + ") u"))
def p4_null_ratio(spark, sf):
    return clean.null_ratio(inc(spark, sf))


@register("p5_zero_to_null", with_base(
    "SELECT incident_id, nullif(lat, 0) AS lat, nullif(lon, 0) AS lon FROM incidents"))
def p5_zero_to_null(spark, sf):
    return clean.zero_to_null(inc(spark, sf).select("incident_id", "lat", "lon"), ["lat", "lon"])


@register("p6_drop_any_null", with_base(
    "SELECT * FROM incidents WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in INC_COLS)))
def p6_drop_any_null(spark, sf):
    return clean.drop_any_null(inc(spark, sf))


@register("p7_drop_null_subset", with_base(
    "SELECT * FROM incidents WHERE vict_age IS NOT NULL AND vict_sex IS NOT NULL"))
def p7_drop_null_subset(spark, sf):
    return clean.drop_null(inc(spark, sf), ["vict_age", "vict_sex"])


@register("p8_clean_age", with_base(
    "SELECT incident_id, CASE WHEN vict_age >= 1 THEN vict_age END AS vict_age FROM incidents"))
def p8_clean_age(spark, sf):
    return clean.clean_age(inc(spark, sf).select("incident_id", "vict_age"))


@register("p9_fill_defaults", with_base(
    "SELECT incident_id, COALESCE(vict_sex, 'X') AS vict_sex, COALESCE(vict_age, 0) AS vict_age FROM incidents"))
def p9_fill_defaults(spark, sf):
    return clean.fill_defaults(inc(spark, sf).select("incident_id", "vict_sex", "vict_age"),
                               {"vict_sex": "X", "vict_age": 0})


@register("p10_fill_text", with_base(
    "SELECT incident_id, COALESCE(time_occ, 'N/A') AS time_occ, COALESCE(vict_sex, 'N/A') AS vict_sex, "
    "COALESCE(category, 'N/A') AS category, vict_age FROM incidents"))
def p10_fill_text(spark, sf):
    return clean.fill_text(inc(spark, sf).select("incident_id", "time_occ", "vict_sex", "category", "vict_age"))


@register("p11_normalise_codes", with_base(
    "SELECT incident_id, CASE WHEN vict_sex IN ('H', '-') THEN 'X' ELSE vict_sex END AS vict_sex FROM incidents"))
def p11_normalise_codes(spark, sf):
    return clean.normalise_codes(inc(spark, sf).select("incident_id", "vict_sex"), "vict_sex", {"H": "X", "-": "X"})


@register("p12_valid_location", with_base(
    "SELECT incident_id, lat, lon FROM incidents WHERE lat <> 0 AND lon <> 0"))
def p12_valid_location(spark, sf):
    return clean.valid_location(inc(spark, sf).select("incident_id", "lat", "lon"))


@register("p13_drop_columns", with_base(
    "SELECT incident_id, area, crm_cd, lat, lon FROM incidents"))
def p13_drop_columns(spark, sf):
    return clean.drop_columns(inc(spark, sf), ["occ_date", "rptd_date", "time_occ", "vict_age",
                                               "vict_sex", "category", "amount"])


@register("p14_filter_eq", with_base(
    "SELECT incident_id, area, category FROM incidents WHERE area = 1 AND category <> 'error'"))
def p14_filter_eq(spark, sf):
    d = clean.filter_eq(inc(spark, sf), "area", 1)
    return clean.filter_eq(d, "category", "error", negate=True).select("incident_id", "area", "category")


@register("p15_filter_in", with_base(
    "SELECT incident_id, area FROM incidents WHERE area IN (1, 2, 3)"))
def p15_filter_in(spark, sf):
    return clean.filter_in(inc(spark, sf), "area", [1, 2, 3]).select("incident_id", "area")


@register("p17_coerce", with_base(
    "SELECT incident_id, TRY_CAST(time_occ AS DOUBLE) AS time_num, CAST(area AS VARCHAR) AS area_text, "
    "TRY_CAST(vict_sex AS DOUBLE) AS sex_num FROM incidents"))
def p17_coerce(spark, sf):
    d = inc(spark, sf).select("incident_id", F.col("time_occ").alias("time_num"),
                              F.col("area").alias("area_text"), F.col("vict_sex").alias("sex_num"))
    d = clean.coerce_double(d, ["time_num", "sex_num"])
    return clean.to_text(d, ["area_text"])


@register("p18_prepare", with_base("SELECT * FROM prepared"))
def p18_prepare(spark, sf):
    return prep(spark, sf)


@register("p19_enrich", with_base(
    "SELECT * EXCLUDE (occ_ts), CAST(occ_ts AS VARCHAR) AS occ_ts FROM enriched"))
def p19_enrich(spark, sf):
    return enr(spark, sf).withColumn("occ_ts", F.col("occ_ts").cast("string"))


# ---------------------------------------------------------------- scalar D*, C*

ORDER_TXT_DUCK = "strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p')"


@register("d1_parse_dates",
          "SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') AS date_text, "
          "CAST(o_orderdate AS DATE) AS parsed FROM orders")
def d1_parse_dates(spark, sf):
    o = fixtures.orders(spark, sf).select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a").alias("date_text"))
    return o.withColumn("parsed", cal.parse_date("date_text"))


@register("d2_format_clock", with_base(
    f"SELECT incident_id, {CLOCK_SQL} AS clock FROM incidents"))
def d2_format_clock(spark, sf):
    return inc(spark, sf).select("incident_id", cal.format_clock("time_occ").alias("clock"))


@register("d3_occurred_at", with_base(
    "SELECT incident_id, CAST(occ_ts AS VARCHAR) AS occ_ts FROM enriched"))
def d3_occurred_at(spark, sf):
    return enr(spark, sf).select("incident_id", F.col("occ_ts").cast("string").alias("occ_ts"))


@register("d4_d5_hour_and_shift", with_base(
    "SELECT incident_id, hour, time_slot FROM enriched"))
def d4_d5_hour_and_shift(spark, sf):
    d = inc(spark, sf).withColumn("ts", cal.occurred_at("occ_date", cal.format_clock("time_occ")))
    d = clean.valid_location(clean.drop_null(clean.clean_age(d), ["vict_age"]))
    return d.select("incident_id", cal.hour_of("ts").alias("hour"), cal.time_slot(cal.hour_of("ts")).alias("time_slot"))


@register("d6_year_month",
          "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m "
          "FROM orders")
def d6_year_month(spark, sf):
    o = fixtures.orders(spark, sf)
    return o.select("o_orderkey", cal.year_of("o_orderdate").alias("y"), cal.month_of("o_orderdate").alias("m"))


@register("d7_weekday", with_base(
    "SELECT incident_id, CAST(dayofweek(occ_date) + 1 AS INTEGER) AS weekday, dayname(occ_date) AS weekday_name "
    "FROM incidents"))
def d7_weekday(spark, sf):
    return inc(spark, sf).select("incident_id", cal.weekday("occ_date").alias("weekday"),
                                 cal.weekday_name("occ_date").alias("weekday_name"))


@register("d8_day_of_month", with_base(
    "SELECT incident_id, CAST(day(rptd_date) AS INTEGER) AS day_of_month FROM incidents"))
def d8_day_of_month(spark, sf):
    return inc(spark, sf).select("incident_id", cal.day_of_month("rptd_date").alias("day_of_month"))


@register("d9_year_month_key",
          "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders")
def d9_year_month_key(spark, sf):
    return fixtures.orders(spark, sf).select("o_orderkey", cal.year_month("o_orderdate").alias("ym"))


@register("d10_report_lag", with_base(
    "SELECT incident_id, round(date_diff('second', CAST(occ_date AS TIMESTAMP), CAST(rptd_date AS TIMESTAMP)) "
    "/ 86400.0, 6) AS lag_days FROM incidents"))
def d10_report_lag(spark, sf):
    return inc(spark, sf).select("incident_id",
                                 F.round(cal.report_lag_days("rptd_date", "occ_date"), 6).alias("lag_days"))


@register("d11_cyclic_hour", with_base(
    "SELECT incident_id, round(sin(2 * pi() * hour / 24.0), 6) AS hour_sin, "
    "round(cos(2 * pi() * hour / 24.0), 6) AS hour_cos FROM enriched"))
def d11_cyclic_hour(spark, sf):
    return enr(spark, sf).select("incident_id", F.round(cal.hour_sin("hour"), 6).alias("hour_sin"),
                                 F.round(cal.hour_cos("hour"), 6).alias("hour_cos"))


@register("d12_mean_age_int", with_base(
    "SELECT area, CAST(trunc(avg(vict_age)) AS INTEGER) AS mean_age FROM prepared GROUP BY area"))
def d12_mean_age_int(spark, sf):
    return prep(spark, sf).groupBy("area").agg(cal.trunc_int(F.avg("vict_age")).alias("mean_age"))


@register("c1_descent_label", with_base(
    f"SELECT incident_id, d AS descent, COALESCE(m.label, 'Unknown') AS descent_label FROM "
    f"(SELECT incident_id, {DESCENT_DUCK} AS d FROM incidents) x LEFT JOIN (VALUES "
    + ", ".join(f"('{c}', '{lab}')" for c, lab in fixed.descent_codes())
    + ") AS m(code, label) ON x.d = m.code"))
def c1_descent_label(spark, sf):
    d = inc(spark, sf).select("incident_id", F.expr(DESCENT_SPARK).alias("descent"))
    return d.withColumn("descent_label", codes.descent_label("descent"))


@register("c2_age_group", with_base(
    f"SELECT incident_id, vict_age, {AGE_GROUP_SQL} AS age_group FROM incidents"))
def c2_age_group(spark, sf):
    return inc(spark, sf).select("incident_id", "vict_age", codes.age_group("vict_age").alias("age_group"))


@register("c3_category_of", with_base(
    "SELECT i.incident_id, i.crm_cd, COALESCE(cat.crime_category, 'Unknown') AS crime_category FROM incidents i "
    "LEFT JOIN " + codes.category_values_sql() + " ON i.crm_cd = cat.crm_cd"))
def c3_category_of(spark, sf):
    return codes.category_of(inc(spark, sf).select("incident_id", "crm_cd"))


VIOLENT_SQL = ", ".join(f"'{v}'" for v in fixed.VIOLENT_CATEGORIES)


@register("c4_crime_type", with_base(
    f"SELECT crime_category, CASE WHEN crime_category IN ({VIOLENT_SQL}) THEN 'Violent' ELSE 'Property' END "
    f"AS crime_type, count(*) AS n FROM enriched GROUP BY ALL"))
def c4_crime_type(spark, sf):
    d = enr(spark, sf).withColumn("crime_type", codes.crime_type("crime_category"))
    return profile.counts_by(d, ["crime_category", "crime_type"])


@register("c5_distance_to_area_centre", with_base(
    "SELECT p.incident_id, round(" + sphere_km_sql("p.lat", "p.lon", "c.clat", "c.clon") + ", 6) AS km "
    "FROM prepared p JOIN (SELECT area, avg(lat) AS clat, avg(lon) AS clon FROM prepared GROUP BY area) c "
    "USING (area)"))
def c5_distance_to_area_centre(spark, sf):
    p = prep(spark, sf)
    c = p.groupBy("area").agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"))
    # One row per area: the join side is an aggregate whose size is the
    # number of areas; AQE broadcasts it at runtime from measured size.
    return p.join(c, "area").select("incident_id", F.round(geo_km("lat", "lon", "clat", "clon"), 6).alias("km"))


# ---------------------------------------------------------------- joins J1, J2

@register("j1_category_inner_counts", with_base(
    "SELECT cat.crime_category, count(*) AS n FROM prepared p JOIN " + codes.category_values_sql()
    + " ON p.crm_cd = cat.crm_cd GROUP BY cat.crime_category"))
def j1_category_inner_counts(spark, sf):
    return profile.counts_by(codes.category_inner(prep(spark, sf)), "crime_category")


@register("j2_category_left_counts", with_base(
    "SELECT crime_category, count(*) AS n FROM enriched GROUP BY crime_category"))
def j2_category_left_counts(spark, sf):
    return profile.counts_by(enr(spark, sf), "crime_category")


# ---------------------------------------------------------------- aggregates A*

@register("a1_per_day", with_base("SELECT occ_date, count(*) AS n FROM enriched GROUP BY occ_date"))
def a1_per_day(spark, sf):
    return profile.counts_by(enr(spark, sf), "occ_date")


@register("a2_busiest_day", with_base(
    "SELECT max(n) AS max_n FROM (SELECT occ_date, count(*) AS n FROM enriched GROUP BY occ_date) c"))
def a2_busiest_day(spark, sf):
    return profile.max_count(profile.counts_by(enr(spark, sf), "occ_date"))


@register("a3_per_month",
          "SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY 1")
def a3_per_month(spark, sf):
    o = fixtures.orders(spark, sf)
    return profile.counts_by(o.withColumn("month", cal.month_of("o_orderdate")), "month").orderBy("month")


@register("a4_per_weekday", with_base(
    "SELECT CAST(isodow(occ_date) - 1 AS INTEGER) AS weekday_index, dayname(occ_date) AS weekday_name, "
    "count(*) AS n FROM enriched GROUP BY ALL"))
def a4_per_weekday(spark, sf):
    return profile.weekday_counts(enr(spark, sf))


@register("a5_year_month_trend",
          "SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1")
def a5_year_month_trend(spark, sf):
    o = fixtures.orders(spark, sf)
    return profile.counts_by(o.withColumn("ym", cal.year_month("o_orderdate")), "ym").orderBy("ym")


@register("a6_per_area", with_base("SELECT area, count(*) AS n FROM enriched GROUP BY area"))
def a6_per_area(spark, sf):
    return profile.counts_by(enr(spark, sf), "area").orderBy(F.desc("n"))


@register("a7_sex_share", with_base(
    "SELECT vict_sex, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share "
    "FROM enriched GROUP BY vict_sex"))
def a7_sex_share(spark, sf):
    return profile.share_by(enr(spark, sf), "vict_sex")


@register("a8_top_descent", with_base(
    f"SELECT descent, count(*) AS n FROM (SELECT {DESCENT_DUCK} AS descent FROM prepared) d "
    "WHERE descent IS NOT NULL GROUP BY descent ORDER BY n DESC, descent LIMIT 10"))
def a8_top_descent(spark, sf):
    d = prep(spark, sf).select(F.expr(DESCENT_SPARK).alias("descent")).filter(F.col("descent").isNotNull())
    return profile.top_n(profile.counts_by(d, "descent"), [F.desc("n"), F.asc("descent")], 10)


@register("a9_category_share", with_base(
    "SELECT category, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share "
    "FROM enriched GROUP BY category"))
def a9_category_share(spark, sf):
    return profile.share_by(enr(spark, sf), "category")


@register("a10_location_counts", with_base(
    "SELECT lat, lon, count(*) AS n FROM prepared GROUP BY lat, lon"))
def a10_location_counts(spark, sf):
    return profile.counts_by(prep(spark, sf), ["lat", "lon"]).orderBy(F.desc("n"))


@register("a15_area_centre", with_base(
    f"SELECT area, {profile.exact_mean_expr('lat', 6, '//')} AS avg_lat, "
    f"{profile.exact_mean_expr('lon', 6, '//')} AS avg_lon FROM prepared GROUP BY area"))
def a15_area_centre(spark, sf):
    return profile.group_means(prep(spark, sf), "area", ["lat", "lon"])


@register("a16_summary_stats",
          "SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 6) AS mean, "
          "round(stddev_samp(o_totalprice), 6) AS std, CAST(min(o_totalprice) AS DOUBLE) AS min, "
          "round(quantile_cont(o_totalprice, 0.25), 6) AS q25, round(quantile_cont(o_totalprice, 0.5), 6) AS q50, "
          "round(quantile_cont(o_totalprice, 0.75), 6) AS q75, CAST(max(o_totalprice) AS DOUBLE) AS max FROM orders")
def a16_summary_stats(spark, sf):
    return profile.summary_stats(fixtures.orders(spark, sf), "o_totalprice")


@register("a17_sums_per_year",
          "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, "
          "CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS sum_o_totalprice, "
          "CAST(sum(CAST(o_custkey AS DECIMAL(38,2))) AS DOUBLE) AS sum_o_custkey FROM orders GROUP BY 1")
def a17_sums_per_year(spark, sf):
    o = fixtures.orders(spark, sf).withColumn("y", cal.year_of("o_orderdate"))
    return profile.sums_by(o, "y", ["o_totalprice", "o_custkey"])


@register("a18_distinct_sorted", with_base("SELECT DISTINCT category FROM enriched"))
def a18_distinct_sorted(spark, sf):
    return profile.distinct_sorted(enr(spark, sf), "category")


@register("a19_row_multiplicity", with_base(
    "SELECT area, vict_sex, crm_cd, count(*) AS n FROM incidents WHERE category = 'purchase' "
    "GROUP BY area, vict_sex, crm_cd"))
def a19_row_multiplicity(spark, sf):
    d = inc(spark, sf).filter(F.col("category") == "purchase").select("area", "vict_sex", "crm_cd")
    return profile.row_multiplicity(d)


@register("a20_code_dictionary", with_base(
    "SELECT crm_cd, max(category) AS category FROM incidents GROUP BY crm_cd"))
def a20_code_dictionary(spark, sf):
    return profile.code_dictionary(inc(spark, sf), "crm_cd", "category")


CORR_COLS = ["lat", "lon", "vict_age", "amount", "hour"]


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[:i]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM enriched" for a, b in pairs)


@register("a21_corr_matrix", with_base(_corr_sql()))
def a21_corr_matrix(spark, sf):
    return profile.corr_matrix(enr(spark, sf), CORR_COLS)


@register("a24_pivot_day_shift", with_base(
    "SELECT occ_day, count_if(time_slot = 1) AS \"1\", count_if(time_slot = 2) AS \"2\", "
    "count_if(time_slot = 3) AS \"3\" FROM enriched GROUP BY occ_day"))
def a24_pivot_day_shift(spark, sf):
    return profile.pivot_counts(enr(spark, sf), "occ_day", "time_slot", [1, 2, 3])


# ---------------------------------------------------------------- windows W*

@register("w1_top_age_group_per_area", with_base(
    "SELECT area, age_group, n FROM (SELECT area, age_group, count(*) AS n, row_number() OVER "
    "(PARTITION BY area ORDER BY count(*) DESC, age_group) AS r FROM enriched GROUP BY area, age_group) t "
    "WHERE r = 1"))
def w1_top_age_group_per_area(spark, sf):
    c = profile.counts_by(enr(spark, sf), ["area", "age_group"])
    return profile.top1_per_group(c, "area", "age_group")


@register("w2_top_bottom_per_year",
          "SELECT y, o_orderpriority, n, top_rank, bottom_rank FROM (SELECT y, o_orderpriority, n, "
          "row_number() OVER (PARTITION BY y ORDER BY n DESC, o_orderpriority) AS top_rank, "
          "row_number() OVER (PARTITION BY y ORDER BY n ASC, o_orderpriority) AS bottom_rank FROM "
          "(SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority, count(*) AS n FROM orders "
          "GROUP BY ALL) c) r WHERE top_rank <= 2 OR bottom_rank <= 2")
def w2_top_bottom_per_year(spark, sf):
    o = fixtures.orders(spark, sf).withColumn("y", cal.year_of("o_orderdate"))
    c = profile.counts_by(o, ["y", "o_orderpriority"])
    return profile.top_bottom_per_group(c, "y", "o_orderpriority", 2)


@register("w3_share_within_area", with_base(
    "SELECT area, category, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY area), 6) AS share "
    "FROM enriched GROUP BY area, category"))
def w3_share_within_area(spark, sf):
    return profile.share_by(enr(spark, sf), ["area", "category"], within=["area"])


@register("w4_first_difference",
          "SELECT o_orderpriority, ym, n, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY ym) AS diff "
          "FROM (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders "
          "GROUP BY ALL) c")
def w4_first_difference(spark, sf):
    o = fixtures.orders(spark, sf).withColumn("ym", cal.year_month("o_orderdate"))
    c = profile.counts_by(o, ["o_orderpriority", "ym"])
    return profile.first_difference(c, "o_orderpriority", "ym", "n")


# ---------------------------------------------------------------- order O*, sets U*

@register("o1_sort_by_date",
          "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY d, o_orderkey")
def o1_sort_by_date(spark, sf):
    o = fixtures.orders(spark, sf).select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.orderBy("d", "o_orderkey")


@register("o2_top_codes", with_base(
    "SELECT crm_cd, count(*) AS n FROM enriched GROUP BY crm_cd ORDER BY n DESC, crm_cd LIMIT 10"))
def o2_top_codes(spark, sf):
    return profile.top_n(profile.counts_by(enr(spark, sf), "crm_cd"), [F.desc("n"), F.asc("crm_cd")], 10)


@register("o3_area_rank", with_base(
    "SELECT area, count(*) AS n, rank() OVER (ORDER BY count(*) DESC, area) AS rank FROM enriched GROUP BY area"))
def o3_area_rank(spark, sf):
    return profile.rank_by_count(profile.counts_by(enr(spark, sf), "area"), key="area")


@register("o4_rows_of_top_areas", with_base(
    "SELECT incident_id, area FROM enriched WHERE area IN (SELECT area FROM enriched GROUP BY area "
    "ORDER BY count(*) DESC, area LIMIT 3)"))
def o4_rows_of_top_areas(spark, sf):
    return profile.keep_top_groups(enr(spark, sf), "area", 3).select("incident_id", "area")


@register("u1_append", with_base(
    "SELECT incident_id, area, category FROM prepared WHERE area = 1 UNION ALL "
    "SELECT incident_id, area, category FROM prepared WHERE area = 2"))
def u1_append(spark, sf):
    p = prep(spark, sf).select("incident_id", "area", "category")
    return profile.append([p.filter("area = 1"), p.filter("area = 2")])


@register("u2_distinct", with_base("SELECT DISTINCT area, vict_sex FROM prepared"))
def u2_distinct(spark, sf):
    return prep(spark, sf).select("area", "vict_sex").distinct()


# ---------------------------------------------------------------- flagship

@register("flagship_area_shift", with_base(
    "SELECT area, time_slot, count(*) AS n, count(DISTINCT crime_category) AS n_categories, "
    "round(avg(vict_age), 6) AS avg_age FROM enriched GROUP BY area, time_slot"))
def flagship_area_shift(spark, sf):
    from hotbeat.plans.flagship import incidents_per_area_and_shift
    return incidents_per_area_and_shift(spark, sf)


# ---------------------------------------------------------------- spatial J6, J7, W7, A25, A26

from hotbeat.operators import dbscan as dbs  # noqa: E402
from hotbeat.operators import spatial  # noqa: E402

EPS = 0.00055       # fixture radius: two lattice steps in lat, one in lon
MIN_SAMPLES = 5
KNN_K = 5
KNN_CELL = 0.0005


def pts_sql(by: str = "area", src: str = "prepared") -> str:
    return (f"pts AS (SELECT {by}, lat, lon, count(*) AS w, min(incident_id) AS pid FROM {src} "
            f"GROUP BY {by}, lat, lon)")


def nb_sql(eps: float, by: str = "area") -> str:
    return (f"nb AS (SELECT a.{by}, a.pid AS p, b.pid AS q, b.w FROM pts a JOIN pts b ON a.{by} = b.{by} "
            f"AND (a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon) <= {eps!r} * {eps!r})")


def dbscan_ctes(eps: float, min_samples: int, by: str = "area", src: str = "prepared") -> str:
    return ",\n".join([
        pts_sql(by, src), nb_sql(eps, by),
        f"core AS (SELECT p FROM nb GROUP BY p HAVING sum(w) >= {min_samples})",
        "ce AS (SELECT nb.p, nb.q FROM nb JOIN core c1 ON nb.p = c1.p JOIN core c2 ON nb.q = c2.p)",
        "reach(node, lab) AS (SELECT p, p FROM core UNION SELECT ce.q, r.lab FROM reach r JOIN ce ON r.node = ce.p)",
        "comp AS (SELECT node, min(lab) AS lab FROM reach GROUP BY node)",
        "border AS (SELECT nb.p AS node, min(comp.lab) AS lab FROM nb JOIN comp ON nb.q = comp.node "
        "WHERE nb.p NOT IN (SELECT p FROM core) GROUP BY nb.p)",
        "labs AS (SELECT node, lab FROM comp UNION ALL SELECT node, lab FROM border)",
        f"num AS (SELECT pts.{by}, pts.lat, pts.lon, CAST(dense_rank() OVER (PARTITION BY pts.{by} ORDER BY lab) - 1 "
        f"AS INTEGER) AS cluster FROM pts JOIN labs ON pts.pid = labs.node)",
        f"clustered AS (SELECT s.*, COALESCE(num.cluster, -1) AS cluster FROM {src} s LEFT JOIN num "
        f"ON s.{by} = num.{by} AND s.lat = num.lat AND s.lon = num.lon)",
    ])


def clustered(spark, sf):
    """Enriched incidents labelled by density cluster per area (M7)."""
    return dbs.dbscan(enr(spark, sf), EPS, MIN_SAMPLES, by="area")


CLUSTER_CTES = dbscan_ctes(EPS, MIN_SAMPLES, "area", "enriched")


@register("j6_radius_neighbours", with_base(
    "SELECT p AS pid, CAST(sum(w) AS BIGINT) AS nw, count(*) AS n_points FROM nb GROUP BY p",
    pts_sql() + ",\n" + nb_sql(EPS)))
def j6_radius_neighbours(spark, sf):
    pts = spatial.weighted_points(prep(spark, sf), "area")
    return spatial.neighbour_weight(pts, EPS, "area").select(F.col("p").alias("pid"), "nw", "n_points")


KNN_SQL_CTES = pts_sql() + ",\n" + (
    "d AS (SELECT a.pid, sqrt((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon)) AS dist, "
    "b.w FROM pts a JOIN pts b ON a.area = b.area),\n"
    "cw AS (SELECT pid, dist, sum(w) OVER (PARTITION BY pid ORDER BY dist ROWS UNBOUNDED PRECEDING) AS c FROM d),\n"
    f"kd AS (SELECT pid, min(dist) AS kdist FROM cw WHERE c >= {KNN_K} GROUP BY pid)")


@register("j7_knn_distance", with_base(
    "SELECT pts.pid, round(kd.kdist, 9) AS kdist FROM pts LEFT JOIN kd ON pts.pid = kd.pid", KNN_SQL_CTES))
def j7_knn_distance(spark, sf):
    pts = spatial.weighted_points(prep(spark, sf), "area")
    kd = spatial.knn_distance(pts, KNN_K, KNN_CELL, "area")
    return kd.select("pid", F.round("kdist", 9).alias("kdist"))


@register("w7_m10_kdistance_curve", with_base(
    "SELECT pid, round(kdist, 9) AS kdist, row_number() OVER (ORDER BY kdist, pid) AS rank FROM kd",
    KNN_SQL_CTES))
def w7_m10_kdistance_curve(spark, sf):
    pts = spatial.weighted_points(prep(spark, sf), "area")
    c = spatial.kdistance_curve(pts, KNN_K, KNN_CELL, "area")
    return c.select("pid", F.round("kdist", 9).alias("kdist"), F.col("rank").cast("long").alias("rank"))


@register("a25_heat_grid", with_base(
    "SELECT CAST(floor(lat / 0.001) AS BIGINT) AS gx, CAST(floor(lon / 0.001) AS BIGINT) AS gy, count(*) AS n "
    "FROM prepared GROUP BY ALL"))
def a25_heat_grid(spark, sf):
    return spatial.heat_grid(prep(spark, sf), 0.001)


@register("a26_heat_grid_by_category", with_base(
    "SELECT category, CAST(floor(lat / 0.001) AS BIGINT) AS gx, CAST(floor(lon / 0.001) AS BIGINT) AS gy, "
    "count(*) AS n FROM prepared GROUP BY ALL"))
def a26_heat_grid_by_category(spark, sf):
    return spatial.heat_grid(prep(spark, sf), 0.001, by="category")


# ---------------------------------------------------------------- density clustering M3, M7, M9 and users

@register("m7_dbscan_by_area", with_base(
    "SELECT incident_id, area, cluster FROM clustered", CLUSTER_CTES))
def m7_dbscan_by_area(spark, sf):
    return clustered(spark, sf).select("incident_id", "area", "cluster")


@register("m9_dbscan_by_category", with_base(
    "SELECT incident_id, category, cluster FROM clustered",
    dbscan_ctes(EPS, 20, "category", "enriched")))
def m9_dbscan_by_category(spark, sf):
    d = dbs.dbscan(enr(spark, sf), EPS, 20, by="category")
    return d.select("incident_id", "category", "cluster")


@register("m3_density_outliers", with_base(
    "SELECT incident_id, area FROM clustered WHERE cluster = -1",
    dbscan_ctes(0.0004, 2, "area", "prepared")))
def m3_density_outliers(spark, sf):
    return dbs.density_outliers(prep(spark, sf), 0.0004, 2, by="area").select("incident_id", "area")


def dbscan_steps_ctes(eps: float, min_samples: int, by: str, src: str, steps: int) -> str:
    """As ``dbscan_ctes`` for dense neighbourhoods: labels spread by ``steps`` rounds of least labels."""
    head = dbscan_ctes(eps, min_samples, by, src)
    a, b = head.index("reach(node"), head.index("border AS")
    rounds = ["l0 AS (SELECT p AS node, p AS lab FROM core)"]
    rounds += [f"l{k} AS MATERIALIZED (SELECT ce.p AS node, min(l.lab) AS lab FROM ce JOIN l{k - 1} l ON ce.q = l.node GROUP BY ce.p)"
               for k in range(1, steps + 1)]
    return head[:a] + ",\n".join([*rounds, f"comp AS (SELECT node, lab FROM l{steps})"]) + ",\n" + head[b:]


@register("m7_dbscan_by_area_wide", with_base(
    "SELECT incident_id, area, cluster FROM clustered", dbscan_steps_ctes(0.00135, 5, "area", "enriched", 30)))
def m7_dbscan_by_area_wide(spark, sf):
    """The radius of the source workflow: most points of an area are neighbours of many others."""
    return dbs.dbscan(enr(spark, sf), 0.00135, 5, by="area").select("incident_id", "area", "cluster")


@register("m9_dbscan_by_category_wide", with_base(
    "SELECT incident_id, category, cluster FROM clustered", dbscan_steps_ctes(0.1, 1000, "category", "enriched", 6)))
def m9_dbscan_by_category_wide(spark, sf):
    return dbs.dbscan(enr(spark, sf), 0.1, 1000, by="category").select("incident_id", "category", "cluster")


@register("m3_density_outliers_wide", with_base(
    "SELECT s.incident_id, s.area, (c.pid IS NULL) AS noise FROM prepared s JOIN pts ON s.area = pts.area AND s.lat = pts.lat "
    "AND s.lon = pts.lon LEFT JOIN (SELECT DISTINCT nb.p AS pid FROM nb JOIN core ON nb.q = core.p) c ON pts.pid = c.pid",
    pts_sql("area", "prepared") + ",\n" + nb_sql(0.1, "area") + ",\ncore AS (SELECT p FROM nb GROUP BY p HAVING sum(w) >= 2)"))
def m3_density_outliers_wide(spark, sf):
    """Every row with the flag of M3 at the source's radius (0.1) and size (2)."""
    d = dbs.dbscan(prep(spark, sf), 0.1, 2, by="area", out="c")
    return d.select("incident_id", "area", (F.col("c") == -1).alias("noise"))


@register("p16_exclude_noise", with_base(
    "SELECT incident_id, cluster FROM clustered WHERE cluster <> -1", CLUSTER_CTES))
def p16_exclude_noise(spark, sf):
    return clean.exclude_noise(clustered(spark, sf)).select("incident_id", "cluster")


@register("a11_rows_per_cluster", with_base(
    "SELECT area, cluster, count(*) AS n, count(*) OVER (PARTITION BY area) AS n_clusters "
    "FROM clustered WHERE cluster <> -1 GROUP BY area, cluster", CLUSTER_CTES))
def a11_rows_per_cluster(spark, sf):
    from pyspark.sql import Window
    c = profile.counts_by(clean.exclude_noise(clustered(spark, sf)), ["area", "cluster"])
    return c.withColumn("n_clusters", F.count(F.lit(1)).over(Window.partitionBy("area")))


@register("a12_means_per_cluster", with_base(
    "SELECT area, cluster, " + ", ".join(f"{profile.exact_mean_expr(c, 6, '//')} AS avg_{c}"
                                         for c in ["vict_age", "lat", "lon"])
    + " FROM clustered GROUP BY area, cluster", CLUSTER_CTES))
def a12_means_per_cluster(spark, sf):
    return profile.group_means(clustered(spark, sf), ["area", "cluster"], ["vict_age", "lat", "lon"])


@register("a13_cluster_age_counts", with_base(
    "SELECT area, cluster, age_group, count(*) AS n FROM clustered GROUP BY ALL", CLUSTER_CTES))
def a13_cluster_age_counts(spark, sf):
    return profile.counts_by(clustered(spark, sf), ["area", "cluster", "age_group"])


@register("a22_daily_per_cluster", with_base(
    "SELECT area, cluster, occ_date, count(*) AS n FROM clustered WHERE cluster <> -1 GROUP BY ALL",
    CLUSTER_CTES))
def a22_daily_per_cluster(spark, sf):
    return profile.counts_by(clean.exclude_noise(clustered(spark, sf)), ["area", "cluster", "occ_date"])


@register("m15_top_hotspots", with_base(
    "SELECT lat, lon, count(*) AS n FROM clustered WHERE cluster <> -1 GROUP BY lat, lon "
    "ORDER BY n DESC, lat, lon LIMIT 10", CLUSTER_CTES))
def m15_top_hotspots(spark, sf):
    c = profile.counts_by(clean.exclude_noise(clustered(spark, sf)), ["lat", "lon"])
    return profile.top_n(c, [F.desc("n"), F.asc("lat"), F.asc("lon")], 10)


# ---------------------------------------------------------------- outliers M1, M2

from hotbeat.operators import outliers  # noqa: E402


OUTLIER_COLS = ["lat", "lon", "amount"]


def _quartile_sql(method: str) -> str:
    s = {"iqr": "(q3_{c} - q1_{c})", "qstd": "sd_{c}"}[method]
    cond = " OR ".join(f"p.{c} < q1_{c} - 1.5 * {s.format(c=c)} OR p.{c} > q3_{c} + 1.5 * {s.format(c=c)}" for c in OUTLIER_COLS)
    stats = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, stddev_samp({c}) AS sd_{c}" for c in OUTLIER_COLS)
    return f"SELECT p.incident_id, p.lat, p.lon, p.amount FROM prepared p, (SELECT {stats} FROM prepared) b WHERE {cond}"


@register("m1_outliers_iqr", with_base(_quartile_sql("iqr")))
def m1_outliers_iqr(spark, sf):
    return outliers.quartile_outliers(prep(spark, sf), OUTLIER_COLS, "iqr").select("incident_id", "lat", "lon", "amount")


@register("m1_outliers_qstd", with_base(_quartile_sql("qstd")))
def m1_outliers_qstd(spark, sf):
    return outliers.quartile_outliers(prep(spark, sf), OUTLIER_COLS, "qstd").select("incident_id", "lat", "lon", "amount")


_Z_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in OUTLIER_COLS)


@register("m2_outliers_zscore", with_base(
    f"SELECT p.incident_id, p.area FROM prepared p JOIN (SELECT area, {_Z_STATS} FROM prepared GROUP BY area) b USING (area) WHERE "
    + " OR ".join(f"abs(p.{c} - m_{c}) / s_{c} > 3.0" for c in OUTLIER_COLS)))
def m2_outliers_zscore(spark, sf):
    return outliers.zscore_outliers(prep(spark, sf), OUTLIER_COLS, 3.0, by="area").select("incident_id", "area")


# ---------------------------------------------------------------- density M11, M12, M13

from hotbeat.operators import density  # noqa: E402

KDE_GRID = 100
KDE_PAD = 0.01


def kde_ctes(by: list[str], src: str, grid: int = KDE_GRID, pad: float = KDE_PAD) -> str:
    g = ", ".join(by)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in by)
    f = "pow(n, -1.0 / 3.0)"
    return ",\n".join([
        f"kst AS (SELECT {g}, count(*) AS n, var_samp(lat) AS sxx, var_samp(lon) AS syy, covar_samp(lat, lon) AS sxy, "
        f"min(lat) AS x_lo, max(lat) AS x_hi, min(lon) AS y_lo, max(lon) AS y_hi FROM {src} GROUP BY {g})",
        f"kb1 AS (SELECT *, sxx * {f} AS hxx, syy * {f} AS hyy, sxy * {f} AS hxy FROM kst)",
        "kb2 AS (SELECT *, hxx * hyy - hxy * hxy AS det FROM kb1)",
        f"kb3 AS (SELECT *, hyy / det AS ixx, hxx / det AS iyy, -hxy / det AS ixy, "
        f"1.0 / ({2 * math.pi!r} * sqrt(det) * n) AS norm, x_lo - {pad!r} AS x0, y_lo - {pad!r} AS y0 "
        "FROM kb2 WHERE det > 0)",
        f"kb AS (SELECT *, (x_hi + {pad!r} - x0) / {grid - 1} AS dx, (y_hi + {pad!r} - y0) / {grid - 1} AS dy FROM kb3)",
        f"kpts AS (SELECT {g}, lat, lon, count(*) AS w FROM {src} GROUP BY {g}, lat, lon)",
        f"kc AS (SELECT {', '.join('b.' + c for c in by)}, gi.i, gj.j, b.x0 + gi.i * b.dx AS gx, b.y0 + gj.j * b.dy AS gy, "
        f"p.w, p.lat, p.lon, b.ixx, b.iyy, b.ixy, b.norm FROM kpts p JOIN kb b ON {on('p', 'b')} "
        f"CROSS JOIN range({grid}) gi(i) CROSS JOIN range({grid}) gj(j))",
        f"kd AS (SELECT {g}, i, j, gx, gy, sum(w * exp(-0.5 * (ixx * (gx - lat) * (gx - lat) + "
        f"2.0 * ixy * (gx - lat) * (gy - lon) + iyy * (gy - lon) * (gy - lon)))) AS s, max(norm) AS norm "
        f"FROM kc GROUP BY {g}, i, j, gx, gy)",
        f"kpk AS (SELECT * FROM (SELECT *, s * norm AS density, row_number() OVER (PARTITION BY {g} ORDER BY round(s, 9) DESC, i, j) AS r "
        f"FROM kd) WHERE r = 1)",
        f"kmean AS (SELECT {g}, avg(lat) AS mx, avg(lon) AS my, count(*) AS n FROM {src} GROUP BY {g})",
        f"kpeak AS (SELECT {', '.join('m.' + c for c in by)}, COALESCE(k.gx, m.mx) AS peak_lat, "
        f"COALESCE(k.gy, m.my) AS peak_lon, k.density, m.n FROM kmean m LEFT JOIN kpk k ON {on('m', 'k')})",
    ])


def _peak_cols(by):
    return [*by, F.round("peak_lat", 6).alias("peak_lat"), F.round("peak_lon", 6).alias("peak_lon"),
            F.round("density", 2).alias("density"), "n"]


PEAK_SELECT = "round(peak_lat, 6) AS peak_lat, round(peak_lon, 6) AS peak_lon, round(density, 2) AS density, n"


@register("m12_kde_peak_per_area", with_base(
    f"SELECT area, {PEAK_SELECT} FROM kpeak", kde_ctes(["area"], "prepared")))
def m12_kde_peak_per_area(spark, sf):
    return density.kde_peak(prep(spark, sf), "area", KDE_GRID, KDE_PAD).select(*_peak_cols(["area"]))


@register("m11_kde_peak_per_cluster", with_base(
    f"SELECT area, cluster, {PEAK_SELECT} FROM kpeak",
    CLUSTER_CTES + ",\nnonnoise AS (SELECT * FROM clustered WHERE cluster <> -1),\n"
    + kde_ctes(["area", "cluster"], "nonnoise")))
def m11_kde_peak_per_cluster(spark, sf):
    c = clean.exclude_noise(clustered(spark, sf))
    return density.kde_peak(c, ["area", "cluster"], KDE_GRID, KDE_PAD).select(*_peak_cols(["area", "cluster"]))


@register("m13_kde_surface", with_base(
    "SELECT area, i, j, round(gx, 6) AS gx, round(gy, 6) AS gy, round(s * norm, 2) AS density FROM kd",
    kde_ctes(["area"], "prepared")))
def m13_kde_surface(spark, sf):
    g = density.kde_grid(prep(spark, sf), "area", KDE_GRID, KDE_PAD)
    return g.select("area", "i", "j", F.round("gx", 6).alias("gx"), F.round("gy", 6).alias("gy"),
                    F.round("density", 2).alias("density"))


# ---------------------------------------------------------------- k-means M4, M5, M6, M14

from hotbeat.operators import kmeans as km  # noqa: E402


@register("m4_kmeans_by_area")
def m4_kmeans_by_area(spark, sf):
    """k = 10 per area on (lat, lon); invariant-checked (nearest own centre)."""
    return km.kmeans_labels(prep(spark, sf), ["lat", "lon"], 10, by="area").select("incident_id", "area", "cluster")


@register("m5_assign_to_area_centres", with_base(
    "SELECT incident_id, cluster FROM (SELECT p.incident_id, c.area AS cluster, row_number() OVER "
    "(PARTITION BY p.incident_id ORDER BY (p.lat - c.clat) * (p.lat - c.clat) + (p.lon - c.clon) * (p.lon - c.clon), "
    "c.area) AS r FROM prepared p, (SELECT area, " + profile.exact_mean_expr("lat", 6, "//") + " AS clat, "
    + profile.exact_mean_expr("lon", 6, "//") + " AS clon FROM prepared GROUP BY area) c) t WHERE r = 1"))
def m5_assign_to_area_centres(spark, sf):
    p = prep(spark, sf)
    centres = (profile.group_means(p, "area", ["lat", "lon"])
               .select(F.col("area").alias("cluster"), F.col("avg_lat").alias("lat"), F.col("avg_lon").alias("lon")))
    return km.assign(p, centres, ["lat", "lon"], None, out="cluster").select("incident_id", "cluster")


@register("m6_elbow")
def m6_elbow(spark, sf):
    """WCSS per (area, k) for k = 1..19 in one keyed fit, and over all areas (area null) for k = 1..29; invariant-checked."""
    p = prep(spark, sf)
    each = km.elbow(p, ["lat", "lon"], range(1, 20), by="area")
    overall = km.elbow(p, ["lat", "lon"], range(1, 30)).withColumn("area", F.lit(None).cast(p.schema["area"].dataType))
    return each.unionByName(overall.select("area", "k", "wcss"))


@register("m4_kmeans_check", with_base("SELECT area, count(*) AS n, 0 AS misplaced FROM prepared GROUP BY area"))
def m4_kmeans_check(spark, sf):
    """M4 by area: rows, and rows for which the mean of another cluster lies nearer than that of their own."""
    d = cut_lineage(km.kmeans_labels(prep(spark, sf), ["lat", "lon"], 10, by="area", tol=0.0).select("area", "lat", "lon", "cluster"))
    means = d.groupBy("area", "cluster").agg(F.avg("lat").alias("a"), F.avg("lon").alias("b"))
    centres = means.groupBy("area").agg(F.collect_list(F.struct("cluster", "a", "b")).alias("cs"))  # ten an area
    dist = lambda c: (F.col("lat") - c["a"]) * (F.col("lat") - c["a"]) + (F.col("lon") - c["b"]) * (F.col("lon") - c["b"])
    own = F.array_min(F.transform(F.filter("cs", lambda c: c["cluster"] == F.col("cluster")), dist))
    least = F.array_min(F.transform("cs", dist))
    return (d.join(centres, "area").groupBy("area").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(own > least + 1e-12, 1)).cast("int").alias("misplaced")))


@register("m6_elbow_k1", with_base(
    "SELECT area, round((var_pop(lat) + var_pop(lon)) * count(*) * 1e6, 3) AS wcss_e6 FROM prepared GROUP BY area"))
def m6_elbow_k1(spark, sf):
    e = km.elbow(prep(spark, sf), ["lat", "lon"], [1], by="area")
    return e.select("area", F.round(F.col("wcss") * 1e6, 3).alias("wcss_e6"))


@register("m14_kprototypes")
def m14_kprototypes(spark, sf):
    """K-prototypes on (lat, lon, vict_age) + (category, vict_sex), k = 10 per area, 5 starts."""
    nums, cats = ["lat", "lon", "vict_age"], ["category", "vict_sex"]
    p = cut_lineage(prep(spark, sf).select("incident_id", "area", *nums, *cats))  # read three times
    d = km.kprototypes(p, nums, cats, 10, by="area", n_init=5)
    return d.select("incident_id", "area", "cluster")


@register("m14_kprototypes_check", with_base("SELECT area, count(*) AS n, 0 AS misplaced, 0 AS unlabelled FROM prepared GROUP BY area"))
def m14_kprototypes_check(spark, sf):
    """M14 by area: rows, rows that are nearer to the mean and modes of another cluster, rows without a cluster."""
    nums, cats = ["lat", "lon", "vict_age"], ["category", "vict_sex"]
    p = cut_lineage(prep(spark, sf).select("incident_id", "area", *nums, *cats))  # read three times
    gamma = km.default_gamma(p, nums)
    d = cut_lineage(km.kprototypes(p, nums, cats, 10, by="area", gamma=gamma, n_init=1).select("area", *nums, *cats, "cluster"))
    proto = d.groupBy("area", "cluster").agg(*[F.avg(c).alias(f"m_{c}") for c in nums])
    for c in cats:
        n = d.groupBy("area", "cluster", c).agg(F.count("*").alias("n"))
        proto = proto.join(n.groupBy("area", "cluster").agg(F.max_by(c, F.struct("n", c)).alias(f"m_{c}")), ["area", "cluster"])
    lists = proto.groupBy("area").agg(F.collect_list(F.struct("cluster", *[f"m_{c}" for c in nums + cats])).alias("ps"))  # ten an area
    cost = lambda q: (sum([(F.col(c) - q[f"m_{c}"]) * (F.col(c) - q[f"m_{c}"]) for c in nums], F.lit(0.0))
                      + F.lit(gamma) * sum([F.when(F.col(c) == q[f"m_{c}"], 0.0).otherwise(1.0) for c in cats], F.lit(0.0)))
    own = F.array_min(F.transform(F.filter("ps", lambda q: q["cluster"] == F.col("cluster")), cost))
    least = F.array_min(F.transform("ps", cost))
    return (d.join(lists, "area").groupBy("area").agg(
        F.count("*").alias("n"), F.count(F.when(own > least + 1e-6, 1)).cast("int").alias("misplaced"),
        F.count(F.when(F.col("cluster").isNull(), 1)).cast("int").alias("unlabelled")))


# ---------------------------------------------------------------- series A23 / R1, R2, R3, R4, R5

from hotbeat.operators import series as ts  # noqa: E402

SERIES_KEY_SPARK = "CAST(o_custkey % 500 AS INT)"


def order_series(spark, sf):
    o = fixtures.orders(spark, sf).withColumn("grp", F.expr(SERIES_KEY_SPARK))
    return ts.gap_filled_counts(o, "grp", "o_orderdate", "month")


SERIES_CTES = (
    f"oc AS (SELECT {SERIES_KEY_SPARK} AS grp, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, "
    "count(*) AS n FROM orders GROUP BY ALL),\n"
    "span AS (SELECT grp, min(period) AS lo, max(period) AS hi FROM oc GROUP BY grp),\n"
    "grid AS (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM span),\n"
    "ser AS (SELECT g.grp, g.period, CAST(COALESCE(oc.n, 0) AS BIGINT) AS n FROM grid g "
    "LEFT JOIN oc ON g.grp = oc.grp AND g.period = oc.period)")


@register("a23_r1_gap_filled_series", with_base("SELECT grp, period, n FROM ser", SERIES_CTES))
def a23_r1_gap_filled_series(spark, sf):
    return order_series(spark, sf)


_OLS_R2 = ts.ols_exprs("dx", "lx", "duck")
_OLS_R5 = ts.ols_exprs("dx", "dx1", "duck")


@register("r2_stationarity", with_base(
    f"SELECT grp, n, round(slope, 6) AS slope, round(t_stat, 6) AS t_stat, t_stat > -2.86 AS difference FROM ("
    f"SELECT grp, {_OLS_R2['n']} AS n, {_OLS_R2['slope']} AS slope, {_OLS_R2['t']} AS t_stat FROM ("
    "SELECT grp, n - lag(n) OVER (PARTITION BY grp ORDER BY period) AS dx, "
    "lag(n) OVER (PARTITION BY grp ORDER BY period) AS lx FROM ser) s WHERE lx IS NOT NULL GROUP BY grp) r",
    SERIES_CTES))
def r2_stationarity(spark, sf):
    r = ts.stationarity(order_series(spark, sf), "grp")
    return r.select("grp", "n", F.round("slope", 6).alias("slope"), F.round("t_stat", 6).alias("t_stat"),
                    "difference")


@register("r2_augmented_unit_root")
def r2_augmented_unit_root(spark, sf):
    """Augmented Dickey-Fuller test of every series: lags by AIC, p-value, whether to difference."""
    return ts.augmented_stationarity(order_series(spark, sf), "grp")


@register("r5_ar_diff_forecast", with_base(
    "SELECT grp, h, period, round(phi, 6) AS phi, round(c, 6) AS c, round(forecast, 3) AS forecast FROM ("
    "SELECT f.grp, h.h, CAST(f.last_period + h.h * INTERVAL 1 MONTH AS DATE) AS period, f.phi, f.c, "
    "f.x_last + f.c / nullif(1.0 - f.phi, 0) * (h.h - f.phi * (1.0 - pow(f.phi, CAST(h.h AS DOUBLE))) / nullif(1.0 - f.phi, 0)) "
    "+ f.dx_last * (f.phi * (1.0 - pow(f.phi, CAST(h.h AS DOUBLE))) / nullif(1.0 - f.phi, 0)) AS forecast FROM ("
    f"SELECT grp, {_OLS_R5['slope']} AS phi, {_OLS_R5['intercept']} AS c, "
    "arg_max(n, period) AS x_last, "
    "arg_max(dx, period) AS dx_last, max(period) AS last_period FROM ("
    "SELECT grp, period, n, dx, lag(dx) OVER (PARTITION BY grp ORDER BY period) AS dx1 FROM ("
    "SELECT grp, period, n, n - lag(n) OVER (PARTITION BY grp ORDER BY period) AS dx FROM ser) a) b "
    "GROUP BY grp) f, range(1, 7) h(h)) t", SERIES_CTES))
def r5_ar_diff_forecast(spark, sf):
    f = ts.ar_diff_forecast(order_series(spark, sf), "grp", 6)
    return f.select("grp", F.col("h").cast("long").alias("h"), "period", F.round("phi", 6).alias("phi"),
                    F.round("c", 6).alias("c"), F.round("forecast", 3).alias("forecast"))


def cluster_month_series(spark, sf):
    """Monthly incident counts per density cluster (orders stand in for the
    multi-year calendar: clusters of customers by key, as FIXTURES allows)."""
    o = fixtures.orders(spark, sf).withColumn("grp", F.expr("CAST(o_custkey % 20 AS INT)"))
    return ts.gap_filled_counts(o, "grp", "o_orderdate", "month")


@register("r3_arima_111_forecast")
def r3_arima_111_forecast(spark, sf):
    """ARIMA(1,1,1) per series, 12 months ahead with 95 % band."""
    return ts.forecast(cluster_month_series(spark, sf), "grp", (1, 1, 1), 12)


@register("r4_auto_arima_forecast")
def r4_auto_arima_forecast(spark, sf):
    """Lowest-AIC order per series among 18 candidates, 12 months ahead."""
    return ts.auto_forecast(cluster_month_series(spark, sf), "grp", None, 12)


# ---------------------------------------------------------------- splits T*, features F*

from hotbeat.operators import classify as clf  # noqa: E402
from hotbeat.operators import features as feat  # noqa: E402
from hotbeat.operators import trees  # noqa: E402
from hotbeat.operators import split as sp  # noqa: E402


@register("t1_hash_split")
def t1_hash_split(spark, sf):
    """80/20 by hash of the incident id (stable under repartitioning)."""
    return sp.hash_split(enr(spark, sf), "incident_id").select("incident_id", "time_slot", "split")


@register("t2_stratified_split")
def t2_stratified_split(spark, sf):
    return sp.stratified_split(enr(spark, sf), "time_slot", "incident_id").select("incident_id", "time_slot", "split")


@register("t3_stratified_folds")
def t3_stratified_folds(spark, sf):
    return sp.stratified_folds(enr(spark, sf), "time_slot", "incident_id", 5).select("incident_id", "time_slot", "fold")


def _share_sql(n: str) -> str:
    return f"(SELECT time_slot, count(*) AS n FROM enriched GROUP BY time_slot) c, {n}"


@register("t2_split_counts", with_base(
    "SELECT time_slot, s AS split, CASE s WHEN 'train' THEN CAST(floor(n * 0.8) AS BIGINT) ELSE n - CAST(floor(n * 0.8) AS BIGINT) END AS n FROM "
    + _share_sql("(VALUES ('train'), ('test')) v(s)")))
def t2_split_counts(spark, sf):
    """T2 by the number of rows a label and split has; null labels are a label of their own."""
    d = sp.stratified_split(enr(spark, sf).select("incident_id", "time_slot"), "time_slot", "incident_id")
    return d.groupBy("time_slot", "split").agg(F.count(F.lit(1)).alias("n"))


@register("t3_fold_counts", with_base(
    "SELECT time_slot, CAST(f AS INTEGER) AS fold, n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END AS n FROM " + _share_sql("range(5) r(f)")))
def t3_fold_counts(spark, sf):
    d = sp.stratified_folds(enr(spark, sf).select("incident_id", "time_slot"), "time_slot", "incident_id", 5)
    return d.groupBy("time_slot", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("t1_split_share", with_base(
    "SELECT area, count(*) AS n, true AS whole, true AS near_share FROM enriched GROUP BY area"))
def t1_split_share(spark, sf):
    """T1 by area: every row is in one part, and the training part is near four fifths (five standard deviations)."""
    d = sp.hash_split(enr(spark, sf).select("incident_id", "area"), "incident_id").groupBy("area").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("split") == "train", 1)).alias("a"), F.count(F.when(F.col("split") == "test", 1)).alias("b"))
    return d.select("area", "n", (F.col("a") + F.col("b") == F.col("n")).alias("whole"),
                    (F.abs(F.col("a") - F.col("n") * 0.8) <= 5 * F.sqrt(F.col("n") * 0.16)).alias("near_share"))


_SLOTS = ("SELECT '{c}' AS source, CAST({c} AS VARCHAR) AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS slot, count(*) AS n "
          "FROM enriched WHERE {c} IS NOT NULL GROUP BY {c}")


def _slots(spark, sf, cats, nums):
    """Which slot of the assembled vector each level fills: index by frequency, ties by value."""
    from pyspark.ml.functions import vector_to_array
    d = feat.one_hot(enr(spark, sf), cats, nums).withColumn("f", vector_to_array("features"))
    out, offset = None, 0
    for c in cats:
        levels = d.select(c).filter(F.col(c).isNotNull()).distinct().count()
        # the slots of this column: one a level, then one for values not seen in the fit
        part = F.slice("f", offset + 1, levels)
        rows = (d.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(
            F.min(F.array_position(part, F.lit(1.0)) - 1).alias("slot"), F.count(F.lit(1)).alias("n")))
        rows = rows.select(F.lit(c).alias("source"), "value", "slot", "n")
        out = rows if out is None else out.unionByName(rows)
        offset += levels + 1
    return out


@register("f1_slots", with_base(" UNION ALL ".join(f"({_SLOTS.format(c=c)})" for c in ["category", "vict_sex", "age_group"])))
def f1_slots(spark, sf):
    return _slots(spark, sf, ["category", "vict_sex", "age_group"], [])


@register("f2_slots", with_base(" UNION ALL ".join(f"({_SLOTS.format(c=c)})" for c in ["category", "vict_sex"])))
def f2_slots(spark, sf):
    return _slots(spark, sf, ["category", "vict_sex"], ["lat", "lon", "vict_age", "occ_month"])


@register("f1_one_hot")
def f1_one_hot(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = feat.one_hot(enr(spark, sf), ["category", "vict_sex", "age_group"])
    return d.select("incident_id", vector_to_array("features").alias("features"))


@register("f2_one_hot_numeric")
def f2_one_hot_numeric(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = feat.one_hot(enr(spark, sf), ["category", "vict_sex"], ["lat", "lon", "vict_age", "occ_month"])
    return d.select("incident_id", vector_to_array("features").alias("features"))


CATEGORY_LEVELS = ["click", "error", "purchase", "signup", "view"]


@register("f3_dummies_drop_first", with_base(
    "SELECT incident_id, " + ", ".join(f"CASE WHEN category = '{v}' THEN 1 ELSE 0 END AS category_{v}"
                                       for v in CATEGORY_LEVELS[1:]) + " FROM enriched"))
def f3_dummies_drop_first(spark, sf):
    d = feat.dummies(enr(spark, sf).select("incident_id", "category"), "category")
    return d.drop("category")


@register("f4_label_encode", with_base(
    "SELECT incident_id, category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS category_index "
    "FROM enriched"))
def f4_label_encode(spark, sf):
    d, _ = feat.label_encode(enr(spark, sf).select("incident_id", "category"), "category")
    return d


@register("f5_standardise", with_base(
    "SELECT incident_id, round((lat - avg(lat) OVER ()) / stddev_pop(lat) OVER (), 6) AS lat_z, "
    "round((vict_age - avg(vict_age) OVER ()) / stddev_pop(vict_age) OVER (), 6) AS vict_age_z FROM prepared"))
def f5_standardise(spark, sf):
    d = feat.standardise(prep(spark, sf).select("incident_id", "lat", "vict_age"), ["lat", "vict_age"])
    return d.select("incident_id", F.round("lat_z", 6).alias("lat_z"), F.round("vict_age_z", 6).alias("vict_age_z"))


@register("f6_w5_pca_report")
def f6_w5_pca_report(spark, sf):
    """Explained variance with running total (W5) of the 64-d embeddings."""
    emb = feat.embedding_vectors(fixtures.table(spark, sf, "embeddings"))
    var, _, _ = feat.pca_report(emb, vector_col="features", target=0.9)
    return var


@register("f6_pca_feature_ranking")
def f6_pca_feature_ranking(spark, sf):
    """Feature contributions over the components reaching 90 % variance, crime category, sex, month and weekday as dummy columns."""
    d = enr(spark, sf)
    for c, levels in (("crime_category", sorted({c for _, c in fixed.category_codes()} | {"Unknown"})), ("vict_sex", ["F", "H", "M", "X"]),
                      ("occ_month", range(1, 13)), ("occ_weekday", range(1, 8))):
        d = feat.dummies(d, c, levels)
    dummy = {c: re.sub(r"\W+", "_", c) for c in d.columns if c.startswith(("crime_category_", "vict_sex_", "occ_month_", "occ_weekday_"))}
    nums = ["lat", "lon", "vict_age", "amount"]
    _, rank, _ = feat.pca_report(cut_lineage(d.select(*nums, *[F.col(f"`{c}`").alias(n) for c, n in dummy.items()])), [*nums, *dummy.values()], target=0.9)
    return rank


# ---------------------------------------------------------------- classification L*

SHIFT_FEATURES = ["lat", "lon", "occ_month", "occ_weekday"]
#: The tree and cluster models take month and weekday as 0/1 columns (first level dropped).
DUMMY_FEATURES = ["lat", "lon", *[f"occ_month_{m}" for m in range(2, 13)], *[f"occ_weekday_{d}" for d in range(2, 8)]]


def with_dummies(df):
    return feat.dummies(feat.dummies(df, "occ_month", range(1, 13)), "occ_weekday", range(1, 8))


def labelled(spark, sf):
    """Enriched rows with label, split and fold, materialised once (reliable
    checkpoint) because model fitting and scoring read them several times."""
    d = clf.with_label(enr(spark, sf))
    d = cut_lineage(d.select("incident_id", "area", *SHIFT_FEATURES, "vict_age", "amount", "time_slot", "label"))  # a split reads its rows twice
    d = cut_lineage(sp.stratified_split(d, "time_slot", "incident_id"))
    d = sp.stratified_folds(d, "time_slot", "incident_id", 5)
    return cut_lineage(d.select("incident_id", "area", *SHIFT_FEATURES, "vict_age", "amount", "time_slot",
                                "label", "split", "fold"))


@register("l1_logistic_regression")
def l1_logistic_regression(spark, sf):
    d = labelled(spark, sf)
    m = clf.logistic_pipeline(SHIFT_FEATURES, 200).fit(clf.training_rows(d))
    return clf.predict(m, d.filter("split = 'test'"), SHIFT_FEATURES).select("incident_id", "label", "prediction")


SHIFT_COLUMNS = {"occ_month": range(1, 13), "occ_weekday": range(1, 8)}


def shift_cells(d):
    """(columns, cells) of the training split: place in bins, month and weekday as dummy columns."""
    train = clf.training_rows(d)
    columns = trees.fit_columns(train, ["lat", "lon"], SHIFT_COLUMNS)
    return columns, trees.written_cells(train, columns, "label", 3, "fold")


def _searched(spark, sf, family: str):
    columns, c = shift_cells(labelled(spark, sf))
    return trees.search(c, columns, [family])


@register("l2_random_forest_cv")
def l2_random_forest_cv(spark, sf):
    """Accuracy of the 48 settings of the forest search over five stratified folds."""
    return _searched(spark, sf, "random_forest")


@register("l3_gbt_one_vs_rest_cv")
def l3_gbt_one_vs_rest_cv(spark, sf):
    """Accuracy of the 36 settings of first-order boosting: in each round one tree a class against the rest."""
    return _searched(spark, sf, "gradient_boosting")


@register("l4_boosting_xgb_grid_cv")
def l4_boosting_xgb_grid_cv(spark, sf):
    """Accuracy of the 18 settings of second-order boosting."""
    return _searched(spark, sf, "newton_boosting")


@register("l4_boosted_stumps", with_base(
    "SELECT class, feature, round(gain, 6) AS gain, round(0.1 * (y - n / 3.0 - yr + nr / 3.0) / ((n - nr) * 4 / 9.0 + 1), 6) AS left_value, "
    "round(0.1 * (yr - nr / 3.0) / (nr * 4 / 9.0 + 1), 6) AS right_value FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY gain DESC, ord) AS r FROM ("
    "SELECT class, feature, ord, n, nr, y, yr, (y - yr - (n - nr) / 3.0) * (y - yr - (n - nr) / 3.0) / ((n - nr) * 4 / 9.0 + 1) "
    "+ (yr - nr / 3.0) * (yr - nr / 3.0) / (nr * 4 / 9.0 + 1) - (y - n / 3.0) * (y - n / 3.0) / (n * 4 / 9.0 + 1) AS gain "
    "FROM sums WHERE nr > 0 AND nr < n AND nr * 4 / 9.0 >= 1 AND (n - nr) * 4 / 9.0 >= 1) g) x WHERE r = 1",
    "known AS (SELECT time_slot, occ_month, occ_weekday FROM enriched WHERE time_slot IS NOT NULL AND occ_month IS NOT NULL AND occ_weekday IS NOT NULL),\n"
    "dummy AS (SELECT 'occ_month_' || v AS feature, v AS ord, 'm' AS kind, v FROM range(2, 13) t(v) "
    "UNION ALL SELECT 'occ_weekday_' || v, 100 + v, 'w', v FROM range(2, 8) t(v)),\n"
    "sums AS (SELECT CAST(c.c AS INTEGER) AS class, d.feature, d.ord, count(*) AS n, "
    "count(*) FILTER (WHERE CASE d.kind WHEN 'm' THEN k.occ_month ELSE k.occ_weekday END = d.v) AS nr, "
    "count(*) FILTER (WHERE k.time_slot = c.c + 1) AS y, "
    "count(*) FILTER (WHERE k.time_slot = c.c + 1 AND CASE d.kind WHEN 'm' THEN k.occ_month ELSE k.occ_weekday END = d.v) AS yr "
    "FROM known k, dummy d, range(0, 3) c(c) GROUP BY 1, 2, 3)"))
def l4_boosted_stumps(spark, sf):
    """First round of second-order boosting with trees of one split on the dummy columns: split, gain and leaf values."""
    d = clf.with_label(enr(spark, sf))
    columns = trees.fit_columns(d, [], SHIFT_COLUMNS)
    c = trees.written_cells(d, columns, "label", 3)
    nodes = trees.fit_nodes(c, columns, [("newton_boosting", {"trees": 1, "rate": 0.1, "depth": 1})])
    nodes = trees.with_names(nodes, columns).where("tree = 0").withColumn("v", F.col("value")[0])
    at = lambda c, n: F.max(F.when(F.col("node") == n, F.col(c)))
    return (nodes.groupBy("class").agg(at("feature", 1).alias("feature"), F.round(at("gain", 1), 6).alias("gain"),
                                       F.round(at("v", 2), 6).alias("left_value"), F.round(at("v", 3), 6).alias("right_value"))
            .where("feature IS NOT NULL"))


@register("l5_l6_s5_best_model_roundtrip")
def l5_l6_s5_best_model_roundtrip(spark, sf):
    """Cross-validate the three families, refit the best setting of each, keep the family that is best on the
    test split, save its node table, reread it and predict the test split."""
    d = labelled(spark, sf)
    columns, c = shift_cells(d)
    families = ["random_forest", "gradient_boosting", "newton_boosting"]
    best = {r["family"]: r for r in trees.best_settings(trees.search(c, columns, families)).collect()}
    nodes = cut_lineage(trees.fit_nodes(c, columns, [(f, json.loads(best[f]["params"])) for f in families]))
    test = d.filter("split = 'test'")
    accuracy = [trees.predict(test, nodes, columns, i).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] or 0.0
                for i in range(len(families))]
    i = max(range(len(families)), key=lambda k: (accuracy[k], -k))
    path = io.save_snapshot(nodes.where(F.col("model") == i), io.scratch(spark, "best_model"))
    loaded = io.load_snapshot(spark, path)
    return (trees.predict(test, loaded, columns, i).select("incident_id", "label", "prediction")
            .withColumn("family", F.lit(families[i])).withColumn("params", F.lit(best[families[i]]["params"]))
            .withColumn("cv_accuracy", F.lit(best[families[i]]["cv_accuracy"])).withColumn("test_accuracy", F.lit(accuracy[i])))


@register("l7_class_report", with_base(
    "SELECT cls, round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END, 6) AS precision, "
    "round(CASE WHEN support > 0 THEN tp / support ELSE 0.0 END, 6) AS recall, "
    "round(CASE WHEN tp > 0 THEN 2.0 * (tp / predicted) * (tp / support) / (tp / predicted + tp / support) "
    "ELSE 0.0 END, 6) AS f1, CAST(support AS BIGINT) AS support, "
    "round(sum(tp) OVER () / sum(support) OVER (), 6) AS accuracy FROM ("
    "SELECT COALESCE(s.cls, p.cls) AS cls, COALESCE(s.support, 0) AS support, COALESCE(p.predicted, 0) AS predicted, "
    "COALESCE(t.tp, 0) AS tp FROM (SELECT time_slot AS cls, count(*) AS support FROM scored GROUP BY 1) s "
    "FULL JOIN (SELECT predicted_slot AS cls, count(*) AS predicted FROM scored GROUP BY 1) p ON s.cls = p.cls "
    "LEFT JOIN (SELECT time_slot AS cls, count(*) AS tp FROM scored WHERE time_slot = predicted_slot GROUP BY 1) t "
    "ON COALESCE(s.cls, p.cls) = t.cls) r",
    "base AS (SELECT area, occ_weekday, time_slot AS predicted_slot FROM (SELECT area, occ_weekday, time_slot, "
    "row_number() OVER (PARTITION BY area, occ_weekday ORDER BY count(*) DESC, time_slot) AS r FROM enriched "
    "WHERE time_slot IS NOT NULL GROUP BY area, occ_weekday, time_slot) x WHERE r = 1),\n"
    "scored AS (SELECT e.time_slot, b.predicted_slot FROM enriched e JOIN base b USING (area, occ_weekday))"))
def l7_class_report(spark, sf):
    e = enr(spark, sf)
    base = clf.baseline_shift(e, ["area", "occ_weekday"]).drop("support")
    scored = e.join(base, ["area", "occ_weekday"])
    return clf.class_report(scored, "time_slot", "predicted_slot")


IMPORTANCE_LEVELS = {"occ_weekday": range(1, 8), "vict_sex": ["F", "H", "M", "X"], "crime_category": sorted({c for _, c in fixed.category_codes()} | {"Unknown"})}


@register("l8_feature_importance")
def l8_feature_importance(spark, sf):
    """The 20 features that most nodes of a leaf-wise boosted model split on (31 leaves, 100 rounds)."""
    d = clf.with_label(enr(spark, sf))
    d = cut_lineage(sp.hash_split(d, "incident_id").filter("split = 'train'").select(
        "area", "lat", "lon", "vict_age", "amount", "occ_year", "occ_month", "occ_day", *IMPORTANCE_LEVELS, "label"))
    columns = trees.fit_columns(d, ["area", "lat", "lon", "vict_age", "amount", "occ_year", "occ_month", "occ_day"], IMPORTANCE_LEVELS)
    nodes = trees.fit_leafwise(trees.written_cells(d, columns, "label", 3), columns)
    return trees.split_counts(nodes, columns, 20)


@register("l9_per_area_models")
def l9_per_area_models(spark, sf):
    """A logistic model for every area, all fitted together, and its predictions for the area's test rows."""
    d = labelled(spark, sf)
    models = clf.keyed_logistic(clf.training_rows(d), SHIFT_FEATURES, "area")
    return clf.predict_keyed(d.filter("split = 'test'"), models, SHIFT_FEATURES, "area").select("incident_id", "area", "label", "prediction")


CLUSTER_FEATURES = [*DUMMY_FEATURES, "cluster"]


def cluster_model(spark, labelled_clusters):
    """(saved and reloaded pipeline, rows with label, split and dummies)."""
    d = cut_lineage(clf.with_label(labelled_clusters))  # the split reads its rows twice
    d = with_dummies(cut_lineage(sp.stratified_split(d, "time_slot", "incident_id")))  # read by the scaler, the model and its predictions
    m = clf.logistic_pipeline(CLUSTER_FEATURES, 200).fit(clf.training_rows(d))
    return io.load_model(io.save_model(m, io.scratch(spark, "cluster_model"))), d


@register("l10_cluster_feature")
def l10_cluster_feature(spark, sf):
    """Logistic regression with the density-cluster id as an extra feature."""
    e = cut_lineage(enr(spark, sf).select("incident_id", "area", *SHIFT_FEATURES, "time_slot"))
    m, d = cluster_model(spark, dbs.dbscan(e, EPS, MIN_SAMPLES, by="area"))
    return clf.predict(m, d.filter("split = 'test'"), CLUSTER_FEATURES).select("incident_id", "label", "prediction")


@register("l12_baseline_shift", with_base(
    "SELECT area, occ_weekday, predicted_slot, support FROM (SELECT area, occ_weekday, time_slot AS predicted_slot, "
    "count(*) AS support, row_number() OVER (PARTITION BY area, occ_weekday ORDER BY count(*) DESC, time_slot) AS r "
    "FROM enriched WHERE time_slot IS NOT NULL GROUP BY area, occ_weekday, time_slot) x WHERE r = 1"))
def l12_baseline_shift(spark, sf):
    return clf.baseline_shift(enr(spark, sf), ["area", "occ_weekday"])


# ---------------------------------------------------------------- hotspot grid J3, J4, J5, A14, routes G*

from hotbeat.operators import joins as jn  # noqa: E402
from hotbeat.operators import routes as rt  # noqa: E402
from hotbeat.plans import patrol  # noqa: E402

HOTSPOT_CTES = (
    "hs AS (SELECT area, CAST(r - 1 AS INTEGER) AS hotspot_id, lat, lon, n_incidents FROM (SELECT area, lat, lon, "
    "count(*) AS n_incidents, row_number() OVER (PARTITION BY area ORDER BY count(*) DESC, lat, lon) AS r "
    "FROM prepared GROUP BY area, lat, lon) x WHERE r <= 10),\n"
    "base AS (SELECT area, occ_weekday, time_slot AS predicted_slot FROM (SELECT area, occ_weekday, time_slot, "
    "row_number() OVER (PARTITION BY area, occ_weekday ORDER BY count(*) DESC, time_slot) AS r FROM enriched "
    "WHERE time_slot IS NOT NULL GROUP BY area, occ_weekday, time_slot) x WHERE r = 1),\n"
    "grid AS (SELECT hs.area, hs.hotspot_id, CAST(w.w AS INTEGER) AS occ_weekday, CAST(m.m AS INTEGER) AS occ_month "
    "FROM hs, range(1, 8) w(w), range(1, 13) m(m)),\n"
    "scoredgrid AS (SELECT g.*, b.predicted_slot FROM grid g LEFT JOIN base b USING (area, occ_weekday))")


def hotspots_top(spark, sf):
    return jn.top_locations(prep(spark, sf), "area", 10)


@register("j3_scoring_grid", with_base(
    "SELECT area, hotspot_id, occ_weekday, occ_month FROM grid", HOTSPOT_CTES))
def j3_scoring_grid(spark, sf):
    return jn.scoring_grid(hotspots_top(spark, sf)).select("area", "hotspot_id", "occ_weekday", "occ_month")


@register("j4_match_back", with_base(
    "SELECT s.area, s.hotspot_id, s.occ_weekday, s.occ_month, s.predicted_slot, hs.lat, hs.lon "
    "FROM scoredgrid s JOIN hs USING (area, hotspot_id)", HOTSPOT_CTES))
def j4_match_back(spark, sf):
    hs = hotspots_top(spark, sf)
    scored = patrol.baseline_scores(enr(spark, sf), hs.drop("lat", "lon"))
    return jn.match_back(scored.select("area", "hotspot_id", "occ_weekday", "occ_month", "predicted_slot"), hs)


@register("l11_score_hotspot_grid")
def l11_score_hotspot_grid(spark, sf):
    """Grid scored by a saved cluster model and a saved classifier: every hotspot x weekday x month gets a shift.

    k-means centres per area are saved and reread; they give the incidents, and then the hotspots, their cluster
    (M5); the classifier is trained with that column, saved and reread.
    """
    e = cut_lineage(enr(spark, sf))
    centres = km.kmeans(e, ["lat", "lon"], 10, by="area").select("area", "cluster", "lat", "lon")
    saved = io.load_snapshot(spark, io.save_snapshot(centres, io.scratch(spark, "cluster_centres")))
    m, _ = cluster_model(spark, km.assign(e, saved, ["lat", "lon"], "area"))
    hs = km.assign(jn.top_locations(e, "area", 10), saved, ["lat", "lon"], "area")
    grid = with_dummies(jn.scoring_grid(hs))
    return patrol.model_scores(grid, m).select("area", "hotspot_id", "occ_weekday", "occ_month", "predicted_slot")


@register("a14_shift_sets", with_base(
    "SELECT area, predicted_slot, array_to_string(list_sort(list(DISTINCT hotspot_id)), ',') AS hotspots, "
    "count(DISTINCT hotspot_id) AS n_hotspots FROM scoredgrid GROUP BY area, predicted_slot", HOTSPOT_CTES))
def a14_shift_sets(spark, sf):
    hs = hotspots_top(spark, sf)
    s = patrol.shift_sets(patrol.baseline_scores(enr(spark, sf), hs))
    return s.select("area", "predicted_slot", F.array_join("hotspots", ",").alias("hotspots"),
                    F.col("n_hotspots").cast("long").alias("n_hotspots"))


@register("j5_distance_matrix", with_base(
    "SELECT a.area, a.hotspot_id AS a, b.hotspot_id AS b, round(" + sphere_km_sql("a.lat", "a.lon", "b.lat", "b.lon")
    + ", 6) AS km FROM hs a JOIN hs b ON a.area = b.area AND a.hotspot_id < b.hotspot_id", HOTSPOT_CTES))
def j5_distance_matrix(spark, sf):
    d = rt.distance_matrix(hotspots_top(spark, sf), "area")
    return d.select("area", "a", "b", F.round("km", 6).alias("km"))


@register("w6_g1_route_length", with_base(
    "SELECT area, round(COALESCE(sum(km), 0.0), 6) AS km, count(*) AS stops FROM (SELECT area, CASE WHEN plat IS NOT NULL "
    "THEN " + sphere_km_sql("plat", "plon", "lat", "lon") + " END AS km FROM (SELECT area, lat, lon, "
    "lag(lat) OVER (PARTITION BY area ORDER BY hotspot_id) AS plat, lag(lon) OVER (PARTITION BY area ORDER BY "
    "hotspot_id) AS plon FROM hs) l) x GROUP BY area", HOTSPOT_CTES))
def w6_g1_route_length(spark, sf):
    r = rt.route_length(hotspots_top(spark, sf), "area", "hotspot_id")
    return r.select("area", F.round("km", 6).alias("km"), "stops")


@register("g4_route_stops", with_base(
    "SELECT area, row_number() OVER (PARTITION BY area ORDER BY lon, hotspot_id) AS seq, hotspot_id, lat, lon FROM hs",
    HOTSPOT_CTES))
def g4_route_stops(spark, sf):
    hs = hotspots_top(spark, sf)
    # a west-to-east sweep as the given route: array of ids per area (<= 10)
    r = hs.groupBy("area").agg(F.sort_array(F.collect_list(F.struct("lon", "hotspot_id"))).alias("__s"))
    r = r.select("area", F.transform("__s", lambda s: s["hotspot_id"]).alias("route"))
    out = rt.route_stops(r, hs.select("area", "hotspot_id", "lat", "lon"), "area")
    return out.select("area", F.col("seq").cast("long").alias("seq"), "hotspot_id", "lat", "lon")


def _routes_sql(fixed_start: bool) -> str:
    """Shortest open path by visited sets, ten stops at most: one table a step."""
    steps = [
        "hn AS (SELECT area, hotspot_id AS id, lat, lon, row_number() OVER (PARTITION BY area ORDER BY hotspot_id) - 1 AS i FROM hs)",
        "lg AS (SELECT a.area, a.i, b.i AS j, b.id AS to_id, CAST(round((" + sphere_km_sql("a.lat", "a.lon", "b.lat", "b.lon")
        + ") * 1000000) AS BIGINT) AS leg FROM hn a JOIN hn b ON a.area = b.area AND a.i <> b.i)",
        "t0 AS (SELECT area, CAST(1 << i AS BIGINT) AS visited, i AS last, {'length': CAST(0 AS BIGINT), 'route': [id]} AS best FROM hn"
        + (" WHERE i = 0)" if fixed_start else ")")]
    for k in range(1, 10):
        steps.append(
            f"t{k} AS MATERIALIZED (SELECT area, visited, last, min(b) AS best FROM (SELECT t.area, "
            "CASE WHEN lg.j IS NULL THEN t.visited ELSE t.visited | (1 << lg.j) END AS visited, coalesce(lg.j, t.last) AS last, "
            "{'length': t.best.length + coalesce(lg.leg, 0), 'route': CASE WHEN lg.j IS NULL THEN t.best.route "
            f"ELSE list_append(t.best.route, lg.to_id) END}} AS b FROM t{k - 1} t LEFT JOIN lg ON t.area = lg.area AND t.last = lg.i "
            "AND (t.visited & (1 << lg.j)) = 0) GROUP BY area, visited, last)")
    return ",\n".join(steps)


_ROUTES_SELECT = "SELECT area, min(best).route AS route, round(min(best).length / 1000000.0, 6) AS km FROM t9 GROUP BY area"


@register("g2_plan_routes", with_base(_ROUTES_SELECT, HOTSPOT_CTES + ",\n" + _routes_sql(False)))
def g2_plan_routes(spark, sf):
    """Shortest open path over each area's 10 hotspots."""
    r = rt.plan_routes(hotspots_top(spark, sf), "area")
    return r.select("area", "route", F.round("km", 6).alias("km"))


@register("g3_plan_routes_fixed_start", with_base(_ROUTES_SELECT, HOTSPOT_CTES + ",\n" + _routes_sql(True)))
def g3_plan_routes_fixed_start(spark, sf):
    """Same, always starting at the area's busiest hotspot (id 0)."""
    r = rt.plan_routes(hotspots_top(spark, sf), "area", fixed_start=True)
    return r.select("area", "route", F.round("km", 6).alias("km"))


@register("g2_genetic_routes", with_base(
    "SELECT area, least(25, count(*)) AS stops, least(25, count(*)) AS distinct_stops, 1 AS length_agrees "
    "FROM (SELECT DISTINCT area, lat, lon FROM prepared) x GROUP BY area"))
def g2_genetic_routes(spark, sf):
    """Routes over each area's 25 hotspots by evolution: stops, distinct stops, and whether the length is that of the route."""
    hs = cut_lineage(jn.top_locations(prep(spark, sf), "area", 25))
    r = cut_lineage(rt.genetic_routes(hs, "area"))
    legs = rt.route_stops(r, hs.select("area", "hotspot_id", "lat", "lon"), "area")
    length = rt.route_length(legs, "area").select("area", F.col("km").alias("leg_km"))
    return (r.join(length, "area").select("area", F.size("route").cast("long").alias("stops"), F.size(F.array_distinct("route")).cast("long").alias("distinct_stops"),
                                          (F.abs(F.col("km") - F.col("leg_km")) < 1e-3).cast("int").alias("length_agrees")))


@register("flagship_patrol_plan")
def flagship_patrol_plan(spark, sf):
    """incidents -> k-means + KDE hotspots per area -> baseline shift per grid row
    -> shift sets -> route per (area, shift) -> ordered stops."""
    from hotbeat.plans.hotspots import find_hotspots
    e = cut_lineage(enr(spark, sf).select("incident_id", "area", "lat", "lon", "vict_age", "occ_weekday", "time_slot"))  # read five times
    hs = find_hotspots(e, k=10, by="area", grid=KDE_GRID)
    scored = patrol.baseline_scores(e, hs)
    return patrol.plan(scored, hs)


# ---------------------------------------------------------------- M8: density clustering on mixed features

M8_CATS = CATEGORY_LEVELS


def m8_frame(e):
    d = e.select("incident_id", "area", F.col("vict_age").cast("double").alias("age"),
                 F.col("hour").cast("double").alias("hr"), F.col("occ_weekday").cast("double").alias("wd"),
                 *[F.when(F.col("category") == v, 1.0).otherwise(0.0).alias(f"is_{v}") for v in M8_CATS])
    return d


def _m8_sql() -> str:
    cols = ["age", "hr", "wd"] + [f"is_{v}" for v in M8_CATS]
    sel = ("SELECT incident_id, area, CAST(vict_age AS DOUBLE) AS age, CAST(hour AS DOUBLE) AS hr, "
           "CAST(occ_weekday AS DOUBLE) AS wd, "
           + ", ".join(f"CASE WHEN category = '{v}' THEN 1.0 ELSE 0.0 END AS is_{v}" for v in M8_CATS)
           + " FROM enriched")
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols)
    g = ", ".join(cols)
    return ",\n".join([
        f"m8 AS ({sel})",
        f"pts AS (SELECT area, {g}, count(*) AS w, min(incident_id) AS pid FROM m8 "
        f"WHERE age IS NOT NULL AND hr IS NOT NULL AND wd IS NOT NULL GROUP BY area, {g})",
        f"nb AS (SELECT a.area, a.pid AS p, b.pid AS q, b.w FROM pts a JOIN pts b ON a.area = b.area "
        f"AND {d2} <= 3.0 * 3.0)",
        "core AS (SELECT p FROM nb GROUP BY p HAVING sum(w) >= 10)",
        "ce AS (SELECT nb.p, nb.q FROM nb JOIN core c1 ON nb.p = c1.p JOIN core c2 ON nb.q = c2.p)",
        "reach(node, lab) AS (SELECT p, p FROM core UNION SELECT ce.q, r.lab FROM reach r JOIN ce ON r.node = ce.p)",
        "comp AS (SELECT node, min(lab) AS lab FROM reach GROUP BY node)",
        "border AS (SELECT nb.p AS node, min(comp.lab) AS lab FROM nb JOIN comp ON nb.q = comp.node "
        "WHERE nb.p NOT IN (SELECT p FROM core) GROUP BY nb.p)",
        "labs AS (SELECT node, lab FROM comp UNION ALL SELECT node, lab FROM border)",
        f"num AS (SELECT pts.area, {', '.join('pts.' + c for c in cols)}, CAST(dense_rank() OVER "
        f"(PARTITION BY pts.area ORDER BY lab) - 1 AS INTEGER) AS cluster FROM pts JOIN labs ON pts.pid = labs.node)",
        "clustered8 AS (SELECT m8.incident_id, m8.area, COALESCE(num.cluster, -1) AS cluster FROM m8 LEFT JOIN num "
        "ON m8.area = num.area AND " + " AND ".join(f"m8.{c} IS NOT DISTINCT FROM num.{c}" for c in cols) + ")",
    ])


@register("m8_dbscan_mixed_features", with_base("SELECT incident_id, area, cluster FROM clustered8", _m8_sql()))
def m8_dbscan_mixed_features(spark, sf):
    d = cut_lineage(m8_frame(enr(spark, sf)))  # read twice
    out = dbs.dbscan_features(d, 3.0, 10, ["age", "hr", "wd"], [f"is_{v}" for v in M8_CATS], by="area")
    return out.select("incident_id", "area", "cluster")


def _quartile_by_area_sql(method: str) -> str:
    s = {"iqr": "(q3_{c} - q1_{c})", "qstd": "sd_{c}"}[method]
    cond = " OR ".join(f"p.{c} < q1_{c} - 1.5 * {s.format(c=c)} OR p.{c} > q3_{c} + 1.5 * {s.format(c=c)}" for c in OUTLIER_COLS)
    stats = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, stddev_samp({c}) AS sd_{c}" for c in OUTLIER_COLS)
    return ("SELECT p.incident_id, p.area, p.lat, p.lon, p.amount FROM prepared p JOIN "
            f"(SELECT area, {stats} FROM prepared GROUP BY area) b USING (area) WHERE {cond}")


@register("m1_outliers_iqr_by_area", with_base(_quartile_by_area_sql("iqr")))
def m1_outliers_iqr_by_area(spark, sf):
    d = outliers.quartile_outliers(prep(spark, sf), OUTLIER_COLS, "iqr", by="area")
    return d.select("incident_id", "area", *OUTLIER_COLS)


@register("m1_outliers_qstd_by_area", with_base(_quartile_by_area_sql("qstd")))
def m1_outliers_qstd_by_area(spark, sf):
    d = outliers.quartile_outliers(prep(spark, sf), OUTLIER_COLS, "qstd", by="area")
    return d.select("incident_id", "area", *OUTLIER_COLS)


@register("s1_raw_extract_roundtrip", with_base(
    "SELECT incident_id, occ_date, rptd_date, time_occ, area, crm_cd, vict_age, vict_sex, category, lat, lon, "
    "CAST(NULL AS DOUBLE) AS amount FROM incidents"))
def s1_raw_extract_roundtrip(spark, sf):
    """incidents -> 28-column raw text layout (CSV) -> declared-schema scan -> incident schema."""
    path = io.write_csv(io.to_raw_layout(inc(spark, sf)), io.scratch(spark, "raw_extract_csv"))
    return io.from_raw(io.read_raw_incidents(spark, path))
