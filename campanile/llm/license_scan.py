"""License scans by canonical digests.

A text is brought to a canonical form: copyright lines go, case, punctuation and white space are
evened out and equivalent spellings become one.  The digest of the form of the entire text, and of each
of its lines, is joined with the digests of known notices.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Short names and texts of common notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
#: Fixed values, applied in this order to lower-case text: pattern and what takes its place.
STEPS = (
    (r"(?m)^[\x20\x09-\x0D/*#;-]*(?:copyright|\(c\)|©)[^\n]*$", " "),
    (r"https?://", "http "),
    (r"&", " and "),
    (r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "),
    (r"\blicence", "license"),
    (r"\bsub licens", "sublicens"),
    (r"\borganisation", "organization"),
    (r"\bv(?:ersion|er)? ?(?=[0-9])", "version "),
    (r"\bgnu gpl\b", "gnu general public license"),
)


def canonical(text: Column) -> Column:
    """The canonical form; a text of punctuation and copyright lines alone becomes empty."""
    out = F.lower(text)
    for pattern, instead in STEPS:
        out = F.regexp_replace(out, pattern, instead)
    return F.trim(F.regexp_replace(out, " +", " "))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest, license``: one row per canonical form; of two names for one form the first by code point."""
    table = spark.createDataFrame(list(known), "license string, notice string")
    return table.groupBy(F.sha2(canonical(F.col("notice")), 256).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, text_license, line_licenses`` for every row of ``docs(doc_id, text)``.

    ``text_license`` names the license that the entire text is, else null; ``line_licenses`` those that one of its
    lines is, sorted and distinct.  A null or empty text has neither; rows with a null or repeated doc_id keep a row
    each; other columns are ignored; an empty table gives an empty result.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Place 0 is the entire text, the lines follow.
    parts = F.concat(F.array("text"), F.split("text", "\n", -1))
    parts = rows.select("doc_id", F.xxhash64("text").alias("print"), F.posexplode(parts).alias("place", "part"))
    forms = parts.withColumn("form", canonical(F.col("part"))).drop("part")
    digests = forms.select("doc_id", "print", "place", F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"))
    met = digests.join(known, "digest", "left")
    # Equal rows meet in one group; ``copies`` says how many they are.
    found = met.groupBy("doc_id", "print").agg(
        F.max(F.when(F.col("place") == 0, F.col("license"))).alias("text_license"),
        F.sort_array(F.collect_set(F.when(F.col("place") > 0, F.col("license")))).alias("line_licenses"),
        F.sum(F.when(F.col("place") == 0, 1)).alias("copies"))
    return found.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc_id", "text_license", "line_licenses")


def _sql_form(text: str) -> str:
    out = f"lower({text})"
    for pattern, instead in STEPS:
        if "(?=" in pattern:  # this engine has no lookahead
            pattern, instead = pattern.replace("(?=[0-9])", "([0-9])"), instead + "\\1"
        out = f"regexp_replace({out}, '{pattern}', '{instead}', 'g')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


_VALUES = ", ".join("('{}', '{}')".format(name, notice.replace("'", "''")) for name, notice in KNOWN)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
known AS (SELECT form, min(license) AS license FROM (
  SELECT license, {_sql_form('notice')} AS form FROM (VALUES {_VALUES}) AS k(license, notice)) GROUP BY form),
line AS (SELECT DISTINCT rid, license FROM (SELECT rid, {_sql_form('line')} AS form FROM (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)) JOIN known USING (form) WHERE form <> '')
SELECT d.doc_id, known.license AS text_license,
  coalesce((SELECT list(license ORDER BY license) FROM line WHERE line.rid = d.rid), []) AS line_licenses
FROM d LEFT JOIN known ON known.form = {_sql_form('d.text')}
"""
