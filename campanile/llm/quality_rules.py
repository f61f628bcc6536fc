"""Quality rules: repetition within a document and line frequency across a host's documents.

Everything is a DataFrame expression.  Lines are normalised (lower case, digits as 0, one space
for white space) and hashed; a host's documents that hold a line are counted once each, and
lines of more than ``MAX_DOCUMENTS`` documents of the host are removed.  A document of which less than
``MIN_LEFT`` percent of the words are left is depleted and rejected.

:func:`judge` counts documents by id, as its SQL twin does.  :func:`kept_documents`, which runs before near copies
are joined, counts different contents, so a group of copies doesn't make boilerplate of its own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.llm.store import stored

#: A line of more documents of one host than this is boilerplate.
MAX_DOCUMENTS = 10
#: Percentage of a document's words that must be outside boilerplate.
MIN_LEFT = 50
#: The base rules: fewest words, and most words in repeated windows, in percent.
MIN_WORDS, MAX_REPEATED = 20, 30
WINDOW = 8
#: White space, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACE + "+", " "))


def with_repeated_words(rows: DataFrame, words: str = "words", out: str = "n_repeat_words") -> DataFrame:
    """``out``: words in windows of eight that occur twice or more in the text, first occurrence included.

    Window hashes come from word hashes by doubling, one step a projection, so each is computed once.
    Only texts with two equal hashes sort them, with the positions in the low bits; equal neighbours are
    compared word by word before they count.
    """
    rows = rows.withColumn("h1", F.transform(words, lambda w: F.xxhash64(w)))
    for step in (1, 2):
        before, after = f"h{step}", f"h{2 * step}"
        rows = rows.withColumn(after, F.expr(f"transform({before}, (x, i) -> xxhash64(x, get({before}, i + {step})))")).drop(before)
    rows = rows.withColumn("h8", F.expr(
        f"transform(slice(h4, 1, greatest(size({words}) - {WINDOW - 1}, 0)), (x, i) -> xxhash64(x, get(h4, i + 4)))")).drop("h4")
    rows = rows.withColumn("bits", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.length(F.bin(F.size("h8")))))
    rows = rows.withColumn("packed", F.expr(
        "if(bits IS NULL, NULL, sort_array(transform(h8, (x, i) -> shiftleft(shiftright(x, bits), bits) + i)))")).drop("h8")
    rows = rows.withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))

    def equal(other: str) -> str:
        at = lambda x: f"slice({words}, cast({x} & mask as int) + 1, {WINDOW})"
        return f"(shiftright(x, bits) = shiftright({other}, bits) AND {at('x')} = {at(other)})"

    rows = rows.withColumn("again", F.expr(
        f"filter(packed, (x, i) -> coalesce({equal('get(packed, i - 1)')}, false) OR coalesce({equal('get(packed, i + 1)')}, false))")).drop("packed")
    rows = rows.withColumn("again", F.expr("sort_array(transform(again, x -> x & mask))"))
    total = F.expr(f"aggregate(transform(again, (p, i) -> least({WINDOW}L, coalesce(get(again, i + 1) - p, {WINDOW}L))), 0L, (s, x) -> s + x)")
    return rows.withColumn(out, F.coalesce(total, F.lit(0)).cast("bigint")).drop("bits", "mask", "again")


def base_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` beside ``keep`` and ``text``."""
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    trimmed = F.expr(r"trim(BOTH ' \u0009\u000A\u000B\u000C\u000D' FROM text)")
    rows = rows.withColumn("trimmed", trimmed)
    rows = rows.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", SPACE + "+"))).drop("trimmed")
    rows = with_repeated_words(rows).withColumn("lines", _lines(F.col("text")))
    counted = F.struct(
        F.size("words").cast("bigint").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words")
    # Later filters on the features don't cross a generator; below it, Spark would put the whole chain of steps in their place.
    rows = rows.select(*keep, "text", F.explode(F.array(counted)).alias("counted")).select(*keep, "text", "counted.*")
    return rows.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"))


def frequent_lines(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``host, line``: hashes of normalised lines that more than ``max_documents`` documents of a host hold."""
    lines = docs.select(F.col("source").alias("host"), "doc_id", F.explode(F.array_distinct(F.transform(
        _lines(F.col("text").cast("string")), lambda line: F.xxhash64(_normal(line))))).alias("line"))
    counted = lines.groupBy("host", "line").agg(F.count_distinct(F.coalesce("doc_id", F.lit(-1))).alias("n"))
    return counted.filter(F.col("n") > max_documents).select("host", "line")


def lines_of_different_texts(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: int = MIN_LEFT) -> DataFrame:
    """``host, line`` as :func:`frequent_lines`, but exact and near copies of a text count once, whatever their ids.

    A text that the lines of more than ``max_documents`` contents would deplete is mostly made of shared lines.  It
    counts under the rarest of them: near copies of one text share that line, save those in which an edit hit it, which
    share the next one.  So the count of a group's own lines grows with the logarithm of the group only, while a
    line that other texts hold as well has their counts too.
    """
    parts = docs.select(F.col("source").cast("string").alias("host"), F.xxhash64("text").alias("print"), F.explode(F.transform(
        _lines(F.col("text").cast("string")),
        lambda line: F.struct(F.xxhash64(_normal(line)).alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words")))).alias("part"))
    # Equal texts of a host are one group each; their words are summed over the copies, which leaves shares as they are.
    lines = stored(parts.groupBy("host", "print", "part.line").agg(F.sum("part.words").alias("words")), "lines")
    first = lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > max_documents)
    first = first.select(F.col("host").alias("in_host"), F.col("line").alias("held"), "n")
    met = lines.join(first, lines["host"].eqNullSafe(first["in_host"]) & (lines["line"] == first["held"]), "left")
    texts = met.groupBy("host", "print").agg(
        F.sum("words").alias("words"), F.sum(F.when(F.col("n").isNotNull(), F.col("words"))).alias("shared"),
        F.min(F.when(F.col("n").isNotNull(), F.struct("n", "line"))).alias("rarest"))
    depleted = texts.filter(f"100 * (words - shared) < {min_left} * words").select(
        F.col("host").alias("of_host"), F.col("print").alias("of_print"), F.col("rarest.line").alias("group"))
    hits = met.filter("n IS NOT NULL").select("host", "print", "line")
    grouped = hits.join(depleted, hits["host"].eqNullSafe(depleted["of_host"]) & (hits["print"] == depleted["of_print"]), "left")
    counted = grouped.groupBy("host", "line").agg(F.count_distinct(F.coalesce("group", "print")).alias("n"))
    return counted.filter(F.col("n") > max_documents).select("host", "line")


def _verdicts(docs: DataFrame, frequent: DataFrame, min_left: int) -> DataFrame:
    """One row for all equal rows of ``docs``, known by ``doc_id, source, print``; ``copies`` says how many they are."""
    docs = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    rows = base_features(docs, "doc_id", "source").withColumn("print", F.xxhash64("text"))
    lines = F.transform(_lines(F.col("text")), lambda line: F.struct(
        F.xxhash64(_normal(line)).alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words")))
    rows = rows.select("doc_id", "source", "print", *FEATURES, F.posexplode_outer(lines).alias("at", "part"))
    frequent = frequent.withColumn("frequent", F.lit(True))
    met = rows.join(frequent, rows["source"].eqNullSafe(frequent["host"]) & (F.col("part.line") == frequent["line"]), "left")
    found = met.groupBy("doc_id", "source", "print", *FEATURES).agg(
        F.coalesce(F.sum(F.when(F.col("frequent"), F.col("part.words"))), F.lit(0)).alias("removed"),
        F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, 1)).alias("copies"))
    found = found.withColumn("removed_words", F.expr("removed div copies")).drop("removed")
    return found.withColumn("kept", ~F.col("base_failed") & F.expr(f"100 * (n_words - removed_words) >= {min_left} * n_words"))


def judge(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: int = MIN_LEFT) -> DataFrame:
    """``doc_id``, the base features, ``removed_words`` and ``kept`` for every row of ``docs(doc_id, text, source)``.

    A null or empty text has no words and fails the base rules; a null source is a host of its own; rows with a
    null doc_id count as one document of their host, repeated rows as one; each row of the input, repeated or
    not, has a row in the result.  Other columns are ignored.  An empty table gives an empty result.
    """
    found = _verdicts(docs, frequent_lines(docs.withColumn("source", F.col("source").cast("string")), max_documents), min_left)
    return found.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc_id", *FEATURES, "removed_words", "kept")


def kept_documents(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: int = MIN_LEFT) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and aren't depleted, whole and with all their columns.

    The rules are those of :func:`judge`, with lines counted by :func:`lines_of_different_texts`.
    """
    out = _verdicts(docs, lines_of_different_texts(docs, max_documents, min_left), min_left).filter("NOT kept").select(
        F.col("doc_id").alias("out_id"), F.col("source").alias("out_source"), F.col("print").alias("out_print"))
    met = docs["doc_id"].eqNullSafe(out["out_id"]) & docs["source"].eqNullSafe(out["out_source"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == out["out_print"])
    return docs.join(out, met, "left_anti")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM d),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM base),
win AS (
  SELECT rid, pos, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' ' || lead(word, 3) OVER p
    || ' ' || lead(word, 4) OVER p || ' ' || lead(word, 5) OVER p || ' ' || lead(word, 6) OVER p || ' ' || lead(word, 7) OVER p AS eight
  FROM w WINDOW p AS (PARTITION BY rid ORDER BY pos)),
again AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, eight) AS c FROM win WHERE eight IS NOT NULL) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(pos, pos + 8)) AS p FROM again) GROUP BY rid),
line AS (SELECT rid, doc_id, source, unnest(ls) AS line FROM base),
worded AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
frequent AS (
  SELECT source, norm FROM worded GROUP BY source, norm HAVING count(DISTINCT coalesce(doc_id, -1)) > 10),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY rid),
cut AS (
  SELECT rid, sum(words) AS n FROM worded WHERE EXISTS (
    SELECT 1 FROM frequent f WHERE f.norm = worded.norm AND f.source IS NOT DISTINCT FROM worded.source) GROUP BY rid),
feature AS (
  SELECT base.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(cut.n, 0) AS removed_words
  FROM base LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN cut USING (rid)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM feature)
SELECT doc_id, cast(n_words AS BIGINT) AS n_words, cast(word_chars AS BIGINT) AS word_chars, cast(n_symbols AS BIGINT) AS n_symbols,
  cast(n_dup_lines AS BIGINT) AS n_dup_lines, cast(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  cast(removed_words AS BIGINT) AS removed_words, NOT base_failed AND 100 * (n_words - removed_words) >= 50 * n_words AS kept
FROM failed
"""
