"""DuckDB text of the shared inputs used by the oracle queries.

``base_ctes()`` gives ``incidents`` (FIXTURES view), ``prepared`` (P18) and
``enriched`` (P19) as CTEs; every oracle query is ``WITH <ctes> SELECT ...``.
DuckDB drops CTEs a query does not reference.
"""

from __future__ import annotations

from hotbeat.functions.codes import category_values_sql
from hotbeat.sources.fixtures import INCIDENTS_DUCK_SQL

PREPARED_SQL = """
SELECT incident_id, occ_date, rptd_date, COALESCE(time_occ, 'N/A') AS time_occ, area, crm_cd, vict_age,
       COALESCE(CASE WHEN vict_sex IN ('H', '-') THEN 'X' ELSE vict_sex END, 'X') AS vict_sex,
       COALESCE(category, 'N/A') AS category, lat, lon, amount
FROM (SELECT DISTINCT incident_id, occ_date, rptd_date, time_occ, area, crm_cd,
             CASE WHEN vict_age >= 1 THEN vict_age END AS vict_age, vict_sex, category, lat, lon, amount
      FROM incidents) d
WHERE vict_age IS NOT NULL AND crm_cd IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
  AND lat <> 0 AND lon <> 0
"""

AGE_GROUP_SQL = """CASE WHEN vict_age < 1 THEN 'Infant'
     WHEN vict_age BETWEEN 1 AND 4 THEN 'Toddler'
     WHEN vict_age BETWEEN 5 AND 12 THEN 'Kid'
     WHEN vict_age BETWEEN 13 AND 17 THEN 'Teenager'
     WHEN vict_age BETWEEN 18 AND 25 THEN 'Young Adult'
     WHEN vict_age BETWEEN 26 AND 39 THEN 'Adult'
     WHEN vict_age BETWEEN 40 AND 65 THEN 'Middle Age'
     WHEN vict_age > 65 THEN 'Senior' ELSE 'Unknown' END"""

CLOCK_SQL = """CASE WHEN TRY_CAST(time_occ AS INTEGER) BETWEEN 0 AND 2359
          AND TRY_CAST(time_occ AS INTEGER) % 100 < 60
     THEN substr(lpad(CAST(TRY_CAST(time_occ AS INTEGER) AS VARCHAR), 4, '0'), 1, 2) || ':' ||
          substr(lpad(CAST(TRY_CAST(time_occ AS INTEGER) AS VARCHAR), 4, '0'), 3, 2) END"""

ENRICHED_SQL = f"""
SELECT c.incident_id, c.occ_date, c.rptd_date, c.clock AS time_occ, c.area, c.crm_cd, c.vict_age,
       c.vict_sex, c.category, c.lat, c.lon, c.amount, c.occ_ts,
       CAST(hour(c.occ_ts) AS INTEGER) AS hour,
       CASE WHEN hour(c.occ_ts) < 8 THEN 1 WHEN hour(c.occ_ts) < 16 THEN 2
            WHEN hour(c.occ_ts) IS NOT NULL THEN 3 END AS time_slot,
       CAST(year(c.occ_date) AS INTEGER) AS occ_year,
       CAST(month(c.occ_date) AS INTEGER) AS occ_month,
       CAST(dayofweek(c.occ_date) + 1 AS INTEGER) AS occ_weekday,
       CAST(day(c.occ_date) AS INTEGER) AS occ_day,
       {AGE_GROUP_SQL.replace('vict_age', 'c.vict_age')} AS age_group,
       COALESCE(cat.crime_category, 'Unknown') AS crime_category
FROM (SELECT *, try_strptime(strftime(occ_date, '%Y-%m-%d') || ' ' || clock, '%Y-%m-%d %H:%M') AS occ_ts
      FROM (SELECT *, {CLOCK_SQL} AS clock FROM prepared) p) c
LEFT JOIN {category_values_sql()} ON c.crm_cd = cat.crm_cd
"""


def base_ctes() -> str:
    return (f"WITH RECURSIVE incidents AS ({INCIDENTS_DUCK_SQL}),\n"
            f"prepared AS ({PREPARED_SQL}),\n"
            f"enriched AS ({ENRICHED_SQL})")


def with_base(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` (a bare SELECT) with the base CTEs and optional extra ones."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"{base_ctes()}{extra}\n{sql}"
