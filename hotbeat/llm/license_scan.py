"""Licence scan by ordered signature rules, in DataFrame functions only.

A text that holds none of a few anchor words is done after that look.  The others are normalised to
words, each tagged with its number, so that every match of a rule tells its first and last word.  A
rule's expression runs only where its keyword occurs.  Overlapping detections are resolved by
containment: a detection that lies within another one of the same or a higher priority is dropped
(of two over the same words with the same priority the one listed first stays).  Everything happens
within a row: no shuffle, and repeated or null ids do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.license_rules import rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that always count, with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Every expression demands one of these in the text (``cc by`` has a look of its own).
ANCHORS = ["licen", "spdx", "permission", "copyright", "apache", "gpl", "redistribution", "advertising", "bsd", "mpl",
           "cc0", "commons", "attribution", "domain", "wtfpl", "unencumbered", "neither", "fuck", "implied", "perl",
           "w3c", "nasa", "beer", "evil"]
CC_BY = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"

#: How sure a detection of each priority is.
CONFIDENCE = {1: 0.6, 2: 0.85, 3: 0.95, 4: 0.99}
BASE_CONFIDENCE = 0.8


def tagged_expression(expression: str) -> str:
    """An expression over words as one over `` word#number``."""
    free = "\x00"
    body = expression.replace("[^ ]+", free).replace(" ", "#[0-9]+ ").replace(free, "[^ #]+")
    return f" {body}#[0-9]+"


def _spans(tagged: Column, expression: Column, fields) -> Column:
    number = lambda m, p: F.regexp_extract(m, p, 1).cast("int")
    return F.transform(F.regexp_extract_all(tagged, expression, F.lit(0)),
                       lambda m: F.struct(number(m, "#([0-9]+)").alias("first"), (-number(m, "#([0-9]+)$")).alias("minus_last"), *fields))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score to ``docs``.

    Null text counts as empty: no words, no labels, null word numbers, score 0.  Columns of ``docs``
    that bear one of these names (or the working names ``_scan_*``) are replaced.
    """
    found = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    out = docs.drop(*[c for c in found if c != text])
    source = F.coalesce(F.col(text), F.lit(""))
    low = F.lower(source)
    held = F.col("_scan_low")
    gate = held.rlike(CC_BY)
    for a in ANCHORS:
        gate = held.contains(a) | gate
    out = out.withColumn("_scan_low", low).withColumn("_scan_gate", gate).drop("_scan_low")
    words = F.when(F.col("_scan_gate"), F.regexp_extract_all(F.translate(source, UPPER, LOWER), F.lit(WORD), F.lit(0)))
    out = out.withColumn("_scan_words", words)
    out = (out.withColumn("_scan_plain", F.array_join("_scan_words", " "))
              .withColumn("_scan_tagged", F.array_join(F.transform("_scan_words", lambda w, i: F.concat(F.lit(" "), w, F.lit("#"), i)), "")))
    rule_list = F.array(*[F.struct(F.lit(n).alias("no"), F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                                   F.lit(tagged_expression(e)).alias("expression")) for n, p, label, keyword, e in rules()])
    base_list = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(phrase).alias("keyword"), F.lit(tagged_expression(phrase)).alias("expression"))
                          for phrase, label in BASE.items()])
    plain, tagged = F.col("_scan_plain"), F.col("_scan_tagged")
    hits = F.flatten(F.transform(F.filter(rule_list, lambda r: F.contains(plain, r["keyword"])),
                                 lambda r: _spans(tagged, r["expression"], [(-r["priority"]).alias("minus_priority"), r["no"].alias("no"), r["label"].alias("label")])))
    base = F.flatten(F.transform(F.filter(base_list, lambda r: F.contains(plain, r["keyword"])),
                                 lambda r: _spans(tagged, r["expression"], [r["label"].alias("label")])))
    out = out.withColumn("_scan_hits", F.array_sort(hits)).withColumn("_scan_base", base)

    # sorted by first word, longest first: what may contain a detection comes before it
    levels = sorted(CONFIDENCE)
    start = F.struct(*[F.lit(-1).alias(f"to{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(a: Column, d: Column) -> Column:
        last, priority = -d["minus_last"], -d["minus_priority"]
        covered, sure = F.lit(-1), F.lit(0.0)
        for p in levels:
            covered = F.when(priority == p, a[f"to{p}"]).otherwise(covered)
            sure = F.when(priority == p, F.lit(CONFIDENCE[p])).otherwise(sure)
        stays = covered < last
        return F.struct(*[F.when(priority >= p, F.greatest(a[f"to{p}"], last)).otherwise(a[f"to{p}"]).alias(f"to{p}") for p in levels],
                        F.when(stays, F.array_union(a["labels"], F.array(d["label"]))).otherwise(a["labels"]).alias("labels"),
                        F.when(stays, F.greatest(a["score"], sure)).otherwise(a["score"]).alias("score"))

    out = out.withColumn("_scan_kept", F.aggregate("_scan_hits", start, step))
    base_labels = F.array_distinct(F.transform("_scan_base", lambda d: d["label"]))
    firsts = F.transform("_scan_base", lambda d: d["first"])
    none = F.array().cast("array<string>")
    out = (out.withColumn("n_words", F.regexp_count(source, F.lit(WORD_ANY_CASE)).cast("long"))
              .withColumn("n_base", F.coalesce(F.size("_scan_base"), F.lit(0)).cast("long"))
              .withColumn("first_word", F.array_min(firsts).cast("long")).withColumn("last_word", F.array_max(firsts).cast("long"))
              .withColumn("_scan_base_labels", F.coalesce(base_labels, none)))
    out = (out.withColumn("n_base", F.greatest("n_base", F.lit(0).cast("long")))
              .withColumn("base_labels", F.array_join(F.array_sort("_scan_base_labels"), ","))
              .withColumn("labels", F.array_join(F.array_sort(F.array_union("_scan_base_labels", F.coalesce(F.col("_scan_kept")["labels"], none))), ","))
              .withColumn("score", F.greatest(F.coalesce(F.col("_scan_kept")["score"], F.lit(0.0)),
                                              F.when(F.col("n_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0)))))
    return out.drop("_scan_gate", "_scan_words", "_scan_plain", "_scan_tagged", "_scan_hits", "_scan_base", "_scan_kept", "_scan_base_labels")


def oracle(table: str = "documents") -> str:
    """DuckDB SQL of the scan: all rules over all texts, suppression by comparing all pairs of a text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n".join(f"({n}, {p}, {quote(label)}, {quote(tagged_expression(e))}, {CONFIDENCE[p]})" for n, p, label, _, e in rules())
    base = ",\n".join(f"({quote(label)}, {quote(tagged_expression(phrase))})" for phrase, label in BASE.items())
    return f"""
WITH rules(no, priority, label, expression, sure) AS (VALUES {rows}),
base_rules(label, expression) AS (VALUES {base}),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM {table}),
t AS (
  SELECT doc_id, len(words) AS n_words,
         array_to_string(list_transform(words, lambda w, i: ' ' || w || '#' || CAST(i - 1 AS VARCHAR)), '') AS tagged
  FROM d),
b AS (
  SELECT doc_id, label, unnest(regexp_extract_all(tagged, expression)) AS m
  FROM t, base_rules WHERE regexp_matches(tagged, expression)),
bs AS (
  SELECT doc_id, count(*) AS n_base, min(CAST(regexp_extract(m, '#([0-9]+)', 1) AS BIGINT)) AS first_word,
         max(CAST(regexp_extract(m, '#([0-9]+)', 1) AS BIGINT)) AS last_word, list_sort(list(DISTINCT label)) AS base_list
  FROM b GROUP BY doc_id),
h AS (
  SELECT doc_id, no, priority, label, sure, unnest(regexp_extract_all(tagged, expression)) AS m
  FROM t, rules WHERE regexp_matches(tagged, '#[0-9]+') AND regexp_matches(tagged, expression)),
hs AS (
  SELECT *, CAST(regexp_extract(m, '#([0-9]+)', 1) AS BIGINT) AS f, CAST(regexp_extract(m, '#([0-9]+)$', 1) AS BIGINT) AS l FROM h),
kept AS (
  SELECT * FROM hs x WHERE NOT EXISTS (
    SELECT 1 FROM hs y WHERE y.doc_id = x.doc_id AND y.f <= x.f AND y.l >= x.l AND y.priority >= x.priority
      AND (y.f < x.f OR y.l > x.l OR y.priority > x.priority OR y.no < x.no))),
ks AS (SELECT doc_id, list(DISTINCT label) AS kept_list, max(sure) AS sure FROM kept GROUP BY doc_id)
SELECT t.doc_id, CAST(t.n_words AS BIGINT) AS n_words, coalesce(bs.n_base, 0) AS n_base, bs.first_word, bs.last_word,
       coalesce(array_to_string(bs.base_list, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.base_list, []), coalesce(ks.kept_list, [])))), ','), '') AS labels,
       greatest(coalesce(CAST(ks.sure AS DOUBLE), 0.0), CASE WHEN bs.n_base > 0 THEN {BASE_CONFIDENCE} ELSE 0.0 END) AS score
FROM t LEFT JOIN bs USING (doc_id) LEFT JOIN ks USING (doc_id)
"""
