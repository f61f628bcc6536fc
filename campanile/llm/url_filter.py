"""URL filters by Bloom filter cascades.

A rule or a listed site is a key, a host followed by the start of a path, and fits its host and all
subdomains.  Every url has a few candidate keys: the ends of its host and the starts of its path whose sizes occur
among the listed keys.  The candidate keys of all urls are the complete key universe.  Level 1 of a cascade is a Bloom
filter of the listed keys; level 2 one of the universe's keys that pass level 1 without being listed; level 3
one of the listed keys that pass level 2; and so on, until no key passes falsely.  Then the first level that a key of the
universe doesn't pass tells exactly whether it is listed, so urls are judged row by row, without a join.

DataFrame functions only.  A filter's size follows the list, about three bytes a key, not the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.llm.store import stored

#: Lists of more keys are joined instead of carried as filters; below it a cascade takes some 4 MB at most.
MAX_LISTED = 1 << 20
#: Host, start of path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Sites that are blocked where no rule fits, below each of the top domains.
LISTED_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
TOP_DOMAINS = ("com", "net", "org")
LISTED = tuple(f"{site}.example.{top}" for site in LISTED_SITES for top in TOP_DOMAINS)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, to the next ``?`` or ``#``; it is empty or starts with ``/``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def shapes(listed: DataFrame) -> list[tuple[int, int]]:
    """The pairs of host labels and path characters that occur among ``listed(host, path)``."""
    found = listed.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("chars")).distinct()
    return sorted(tuple(r) for r in found.collect())


def candidate_keys(host: Column, path: Column, sizes: list[tuple[int, int]]) -> Column:
    """Structs ``key, host_chars`` of a url for each of ``sizes`` that it is long enough for."""
    made = []
    for labels, chars in sizes:
        end = F.substring_index(host, ".", -labels)
        fits = (host != "") & (F.regexp_count(host, F.lit(r"\.")) >= labels - 1) & (F.length(path) >= chars)
        key = F.concat(end, F.substring(path, 1, chars))
        made.append(F.when(fits, F.struct(key.alias("key"), F.length(end).alias("host_chars"))))
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<struct<key:string,host_chars:int>>")


@dataclass
class Level:
    """A Bloom filter: ``probes`` places of each key among ``bits``, told apart from other levels by ``seed``."""

    seed: int
    bits: int
    probes: int
    filled: bytearray

    def _place(self, key: Column, probe: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed), probe, key), F.lit(self.bits))

    def passes(self, key: Column) -> Column:
        def is_set(probe: Column) -> Column:
            place = self._place(key, probe)
            byte = F.ascii(F.decode(F.substring(F.lit(self.filled), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
            return F.bit_get(byte, place.bitwiseAND(7).cast("int")) == 1

        return F.forall(F.sequence(F.lit(1), F.lit(self.probes)), is_set)

    def fill(self, keys: DataFrame) -> Level:
        """Set the bits of all keys; words of bits are combined on the map side, ``bits / 64`` of them reach the driver."""
        probes = F.explode(F.sequence(F.lit(1), F.lit(self.probes)))
        places = keys.select("key", probes.alias("probe")).select(self._place(F.col("key"), F.col("probe")).alias("place"))
        one = F.expr("shiftleft(1L, cast(place & 63 as int))")
        words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("set"))
        for row in words.collect():
            self.filled[8 * row["word"]:8 * row["word"] + 8] = row["set"].to_bytes(8, "little", signed=True)
        return self


def _level(seed: int, number: int, share: float) -> Level:
    """An empty filter for ``number`` keys that another key passes with a chance of about ``share``."""
    probes = min(30, max(1, math.ceil(-math.log2(share)))) if share < 1 else 1
    bits = -(-math.ceil(number * probes / math.log(2)) // 64) * 64
    return Level(seed, bits, probes, bytearray(bits // 8))


def build_cascade(universe: DataFrame, listed: DataFrame, seed: int = 0) -> list[Level]:
    """Levels that tell the keys of ``listed(key)`` exactly among all of ``universe(key)``.

    Keys are distinct.  The first level is made so small that about as many other keys pass it as are listed; each further
    level halves what is left.  No listed key gives no level.
    """
    inside = stored(listed.select("key").distinct(), "listed-keys")
    n = inside.count()
    if not n:
        return []
    total = universe.count()
    levels = [_level(seed, n, min(0.5, n * math.sqrt(0.5) / max(total, 1))).fill(inside)]
    passing = universe.filter(levels[0].passes(F.col("key"))).select("key")
    encoded, other = inside, stored(passing.join(inside, "key", "left_anti"), "false-keys")
    while (n := other.count()) > 0:
        level = _level(seed + len(levels), n, 0.5).fill(other)
        levels.append(level)
        # Keys of the level before that pass this one as well are to be told apart by the next.
        encoded, other = other, stored(encoded.filter(level.passes(F.col("key"))), "false-keys")
    return levels


def contains(levels: list[Level], key: Column) -> Column:
    """Whether the cascade holds ``key``, a key of its universe: the first level not passed decides by its parity."""
    found = F.lit(len(levels) % 2 == 1)
    for place in range(len(levels) - 1, -1, -1):
        found = F.when(~levels[place].passes(key), F.lit(place % 2 == 1)).otherwise(found)
    return found


def rule_table(spark: SparkSession, rules=RULES, listed=LISTED) -> DataFrame:
    """``host, path, kind``: rules with their verdicts, and listed sites as kind ``listed``."""
    rows = [(h.translate(str.maketrans(UPPER, LOWER)), p, v) for h, p, v in rules] + [(h, "", "listed") for h in listed]
    return spark.createDataFrame(rows, "host string, path string, kind string")


KINDS = ("block", "allow", "listed")


def _longest(keys: Column, held) -> Column:
    return F.array_max(F.transform(F.filter(keys, lambda k: held(k["key"])), lambda k: F.struct(
        F.length(k["key"]).alias("chars"), k["host_chars"].alias("host_chars"), k["key"].alias("key"))))


def _by_cascades(rows: DataFrame, rules: DataFrame) -> DataFrame:
    universe = stored(rows.select(F.explode("keys").alias("k")).select("k.key").distinct(), "key-universe")
    cascades = {kind: build_cascade(universe, rules.filter(F.col("kind") == kind), 1000 * i) for i, kind in enumerate(KINDS)}
    return rows.select("*", *[_longest(F.col("keys"), lambda key, c=cascades[kind]: contains(c, key)).alias(kind) for kind in KINDS])


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for lists beyond the bound; urls with equal keys are one row of the join."""
    sets = rows.select("keys").distinct()
    met = sets.select("keys", F.explode_outer("keys").alias("k")).join(rules.select(F.col("key").alias("listed_key"), "kind"),
                                                                      F.col("k.key") == F.col("listed_key"), "left")
    place = F.struct(F.length("k.key").alias("chars"), F.col("k.host_chars").alias("host_chars"), F.col("k.key").alias("key"))
    found = met.groupBy("keys").agg(*[F.max(F.when(F.col("kind") == kind, place)).alias(kind) for kind in KINDS])
    return rows.join(found, "keys", "left")


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, max_listed: int = MAX_LISTED) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages(page_id, url)``.

    ``rules(host, path, kind)`` holds keys of kind ``allow``, ``block`` and ``listed``.  Of the allowing and blocking keys
    that fit a url the longest is its rule, of equally long ones that with the longer host; a key of both kinds blocks.
    Without a rule, a url that a listed key fits is blocked, any other allowed.  A null or empty url, or one without
    ``://``, has an empty host and path, no rule, and is allowed.  Rows of any page_id, repeated or null, are judged each; other
    columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    rules = stored(rules.select("kind", "host", "path", F.concat("host", "path").alias("key")).distinct(), "rules")
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes(rules)))
    found = (_by_cascades if rules.count() <= max_listed else _by_join)(rows, rules)
    size = lambda kind: F.struct(F.coalesce(F.col(f"{kind}.chars"), F.lit(-1)), F.coalesce(F.col(f"{kind}.host_chars"), F.lit(-1)))
    blocks = F.col("block").isNotNull() & (size("block") >= size("allow"))
    verdict = F.when(blocks, "block").when(F.col("allow").isNotNull(), "allow").when(F.col("listed").isNotNull(), "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.when(blocks, F.col("block.key")).otherwise(F.col("allow.key")).alias("rule"),
                        verdict.alias("verdict"), F.col("listed").isNotNull().alias("listed"))


_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_LISTED_VALUES = ", ".join(f"'{h}'" for h in LISTED)
SQL = f"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES {_RULE_VALUES}),
fit AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid),
site AS (SELECT rid, len(list_filter([{_LISTED_VALUES}], lambda s: host = s OR ends_with(host, '.' || s))) > 0 AS listed FROM u)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM u LEFT JOIN fit USING (rid) JOIN site USING (rid)
"""
