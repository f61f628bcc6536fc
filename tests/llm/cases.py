"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns of clashing names."""

from __future__ import annotations

import random

SYLLABLES = ("tion ing ver ent he re an st".split(), "zo kul pä dag mub fi gax yo".split())


def words(rng: random.Random, n: int, kind: int = 0) -> list[str]:
    """Words of one of two invented languages."""
    return ["".join(rng.choice(SYLLABLES[kind]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts(seed: int = 7) -> list[tuple]:
    """``doc_id, text, lang, source`` rows."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, 60, i % 2)) for i in range(12)]
    common = "One line that all documents of the host carry along."
    rows = []
    for i in range(12):
        for j in range(3):
            w = base[i].split()
            for _ in range(j):
                w[rng.randrange(len(w))] = "edit" + str(rng.randrange(1000))
            rows.append((10 * i + j, " ".join(w) + "\n" + common, "ab"[i % 2], "s" + str(i % 3)))
    long = " ".join(words(rng, 20_000))
    rows += [(500, long, "a", "s0"), (501, None, "a", "s1"), (502, "", "b", None), (503, " \n\t", None, "s2"), (504, "a b", "a", "s2"),
             (505, "A b", "b", "s1"), (506, "x", None, None), (507, "Ünïcode ß 日本語 😀\x0bend", "a", "s1"), (508, "12 34 !!", "b", "s1"),
             (0, base[0] + "\n" + common, "a", "s0"), (None, base[1], "b", "s1"), (509, "#$ " * 40, "b", "s2"),
             (510, "x " * 30 + "\nsame\nsame\n", "a", "s0")]
    return rows


def frame(spark, rows=None):
    """The rows as a table of several partitions, with columns that operators use as names of their own."""
    schema = "doc_id bigint, text string, lang string, source string"
    out = spark.createDataFrame(texts() if rows is None else rows, schema)
    return out.selectExpr("*", "length(text) AS n_chars", "1 AS score", "2 AS set", "'z' AS word", "0 AS n", "3 AS size", "true AS kept").repartition(3)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
