"""URL filters, conversation repair and hard negatives against brute force, on small hard cases."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from campanile.llm import conversation_repair, hard_negatives, queries, url_filter
from campanile.llm.hard_negatives import Heaps, strassen

FOLDER = "/root/testdata/sf0.01"
URLS = ["https://www.example.com/en/1?x=/de/#t", "http://m.Example.COM/en/2", "https://example.com/en", "http://example.com?/en/", "x://a.com/",
        "https://a.b.net/es/9#f", "net://net/fr/", "https://a.net/de/", "http://spam-farm.example.org", "http://x.spam-farm.example.net/es/1",
        "https://notspam-farm.example.org/", "http://evil.com.org/en/", "no host", "", None, "a://b://c.com/en/", "https:///en/", "http://ÀB.com/\nq",
        "http://" + "a." * 3000 + "com/", "https://h.example.org/" + "p" * 5000]


def brute_verdict(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    under = lambda h: host == h or host.endswith("." + h)
    fit = max(((len(h + p), h + p, v) for h, p, v in url_filter.RULES if under(h) and path.startswith(p)), default=None)
    listed = any(under(h) for h in url_filter.LISTED)
    return host, path, fit and fit[1], fit[2] if fit else "block" if listed else "allow", listed


@pytest.mark.parametrize("bound", [url_filter.MAX_LISTED, 0])
def test_urls_are_judged_as_by_reading_the_rules(spark, bound):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3), max_listed=bound)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *brute_verdict(u)) for i, u, _ in rows), key=repr)
    assert got.limit(0).count() == 0


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id bigint, url string")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    assert url_filter.judge_urls(pages, url_filter.rule_table(spark, (), ())).first().verdict == "allow"


def test_a_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = universe.filter("substring(key, 5) % 7 = 0")
    levels = url_filter.build_cascade(universe, listed)
    assert len(levels) > 2 and sum(len(level.filled) for level in levels) < 6 * 2858
    wrong = universe.filter(url_filter.contains(levels, F.col("key")) != F.expr("substring(key, 5) % 7 = 0"))
    assert wrong.count() == 0


def test_the_url_filter_runs_in_the_jvm_without_joins(spark):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    plan = url_filter.judge_urls(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_repair(rows):
    """All there is to say of one conversation's damaged rows, by a forward search over costs and edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults, made = set(), [], {"s": "system", "u": "user", "a": "assistant"}
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                to = "a" if state == "u" else "u"
                new = (cost + 2, audit + "I", out + [made[to] + ":"])
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        step = {}
        for state, (cost, audit, out) in inserted(best).items():
            options = [(state, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                cut = int(fault == "truncated")
                if (state, role[:1]) in NEXT and role:
                    options.append((NEXT[state, role[:1]], cut, "K", [f"{role}:{text}"]))
                to = "a" if state == "u" else "u"
                options.append((to, 2 + cut, "R", [f"{made[to]}:{text}"]))
            for to, more, letter, line in options:
                new = (cost + more, audit + letter, out + line)
                if to not in step or new < step[to]:
                    step[to] = new
        best = step
    cost, audit, out = min(v for k, v in inserted(best).items() if k in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_damage(rows):
    sp = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20, sp(role), sp(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_conversations(rows):
    found = brute_damage(rows)
    return sorted(((c, *brute_repair([r[1:] for r in found if r[0] == c])) for c in {r[0] for r in rows}), key=repr)


def hard_conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Cut off", "", " \n", "What?", "é.", "Two\nlines. ", "x" * 20_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User"]
    rows = [(c, t, rng.choice(roles[:3 + c % 6]), rng.choice(texts) + (str(t) + "." if rng.random() < 0.6 else "")) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ("user", "assistant")[t % 2 ^ (t % 7 == 0)], f"Turn {t % 90}" + "."[t % 5 == 0:]) for t in range(700)]
    rows += [(None, 0, "user", "a."), (None, None, "user", None), (101, None, None, "b."), (101, None, "assistant", "b."), (102, 5, "user", "z."), (102, 5, "user", "z."),
             (102, 9, "assistant", "z."), (103, 2, "user", "Hi."), (103, 3, "assistant", "Ho.")]
    return rows


def test_conversations_are_repaired_as_by_full_search(spark):
    rows = hard_conversations()
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, cost int, audit string").repartition(5)
    got = conversation_repair.repair(conversation_repair.damaged(frame), frame)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_conversations(rows)
    assert conversation_repair.repair(conversation_repair.damaged(frame.limit(0)), frame.limit(0)).count() == 0


def test_blocks_of_any_size_find_the_same_edits():
    rng = random.Random(3)
    for _ in range(300):
        turns = "".join(rng.choice("suuaaa.SUA,1234uaua") for _ in range(rng.randint(0, 20)))
        assert len({conversation_repair.repair_turns(turns, block) for block in (1, 3, 16, 64)}) == 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_the_conversations_query_is_that_of_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, FOLDER)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_conversations(rows)


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 70), (128, 64, 100), (5, 0, 3)])
def test_strassen_is_exact_even_where_its_sums_wrap(shape):
    m, k, n = shape
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2**45, 2**45, (m, k)), rng.integers(-2**15, 2**15, (k, n))
    a[:1] = 2**61
    b[:, :1] = 0
    assert (strassen(a, b, 4) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    owner, score, ids = rng.integers(0, 4, 200), rng.integers(-3, 3, 200), rng.permutation(200)
    whole, parts = Heaps(4, 3), Heaps(4, 3)
    whole.merge(owner, score, ids)
    for at in range(0, 200, 7):
        parts.merge(owner[at:at + 7], score[at:at + 7], ids[at:at + 7])
    assert [x.tolist() for x in (whole.owner, whole.score, whole.id)] == [x.tolist() for x in (parts.owner, parts.score, parts.id)]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, score string, place int").repartition(3)


def brute_negatives(rows, every, relabel):
    sound = [(i, (y + 1) % 10 if i % relabel == 0 else y, [int(np.floor(256 * x)) for x in v]) for i, v, y in rows
             if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, y, v in sound:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in sound if j != i and len(w) == len(v))
            for p, j in [(-s, j) for s, j, z in scored if z == y][:5]:
                fit = [(-s, n) for s, n, z in scored if z != y and 50 * p <= -100 * s <= 95 * p][:3]
                out += [(i, j, r + 1, n, p, s) for r, (s, n) in enumerate(fit)]
    return sorted(out)


def test_hard_negatives_with_ties_copies_and_bad_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-2, 4, 5) / 4).tolist(), i % 3) for i in range(150)]
    rows += [(200, None, 1), (201, [1.0, None, 0.0, 0.0, 0.0], 1), (202, [float("nan")] * 5, 1), (203, rows[3][1], None), (204, [1.0, 2.0], 1), (205, [], 1),
             (None, rows[3][1], 1), (206, rows[3][1], 0), (206, rows[3][1], 0), (60, rows[60][1], 0), (210, [0.0] * 5, 2), (3, [-1.0] * 5, 1)]
    for name, size in (("ANCHOR_BLOCK", 7), ("CANDIDATE_BLOCK", 40)):
        monkeypatch.setattr(hard_negatives, name, size)
    got = hard_negatives.mine(vectors(spark, rows), 10, 7)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10, 7) != []


def test_hard_negatives_of_few_or_no_vectors(spark):
    assert hard_negatives.mine(vectors(spark, [(0, [1.0], 1)])).count() == 0
    assert hard_negatives.mine(vectors(spark, [(0, [1.0], 1)]).limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_url_filter", "op13_hard_negatives"])
def test_queries_are_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(queries.all_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.all_queries()[name](spark, FOLDER).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
