"""Operators over documents against brute force and round trips, on small hard cases."""

from __future__ import annotations

import collections
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from campanile.llm import bpe, jaccard_join, langid, license_scan, maxent_lm, mixing, quality_rules, toxicity
from campanile.llm.components import components
from campanile.llm.words import shingles, split_words
from tests.llm.cases import collected, frame, texts, words

P = pytest.importorskip("public_tokenizers")
RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def gram_set(text, size=5):
    w = tokens(text)
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def similar_components(rows, percent=80):
    """Least id by row, over all pairs."""
    sets = [gram_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return [(row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows)]


def test_words_and_shingles_are_those_of_the_definition():
    rows = [t for _, t, *_ in texts()]
    found = split_words(rows, lower=True)
    assert [found.data[a:b].tobytes() for a, b in zip(found.start, found.end)] == [w for t in rows for w in tokens(t)]
    grams, text = shingles(found)
    assert [len(set(grams[text == i].tolist())) for i in range(len(rows))] == [len(gram_set(t)) for t in rows]
    assert len(set(found.hashes().tolist())) == len({w for t in rows for w in tokens(t)})


def test_jaccard_join_finds_all_components(spark):
    rows = texts()
    with_id = [r for r in rows if r[0] is not None]
    got = collected(jaccard_join.jaccard_components(frame(spark)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(similar_components(with_id) + [(None, 0, None)], key=repr)


def test_jaccard_join_of_a_large_group_of_near_copies(spark):
    """Copies edited in different places link through each other, not all with one."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(70):
        w = list(base)
        for k in range(1 + i % 4):
            w[(7 * i + 31 * k) % 120] = f"e{i}_{k}"
        rows.append((i, " ".join(w), None, None))
    got = collected(jaccard_join.jaccard_components(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(similar_components(rows), key=repr)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (202, 201), (201, 202)]
    got = dict(collected(components(spark.createDataFrame(edges, "u bigint, v bigint")), "node", "root"))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 201: 201, 202: 201}


def test_quality_rules_match_sql(spark, tmp_path):
    rows = frame(spark).select("doc_id", "text", "source")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    cursor = con.execute(quality_rules.SQL)
    names = [d[0] for d in cursor.description]
    assert collected(quality_rules.judge(frame(spark)), *names) == sorted(cursor.fetchall(), key=repr)


def test_quality_rules_keep_whole_rows(spark):
    docs = frame(spark)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    wanted = quality_rules.judge(docs).filter("kept").groupBy("doc_id").count()
    assert collected(kept.groupBy("doc_id").count(), "*") == collected(wanted, "*")
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_one_of_a_large_group_of_copies_in_one_host_survives(spark):
    rng = random.Random(3)
    lines = [" ".join(words(rng, 12)) for _ in range(20)]
    near = [list(lines) for _ in range(300)]
    for i, copy in enumerate(near):  # one word differs, each line in 15 of them
        copy[i % 20] = f"edit{i} " + copy[i % 20]
    footer = " ".join(words(rng, 30))
    rows = [(i, "\n".join(words(random.Random(5), 40)), "a", "hot") for i in range(1000)]
    rows += [(2000 + i, "\n".join(copy), "a", "hot") for i, copy in enumerate(near)]
    # Boilerplate of different texts goes on: most words of the first, few of the second kind.
    rows += [(3000 + i, " ".join(words(rng, 25)) + "\n" + footer, "a", "cold") for i in range(20)]
    rows += [(4000 + i, " ".join(words(rng, 40)) + "\n" + footer, "a", "cold") for i in range(20)]
    docs = frame(spark, rows)
    poor = corpus_pipeline.drop_poor(spark, docs, "")
    assert {r.doc_id for r in poor.filter("source = 'cold'").collect()} == set(range(4000, 4020))
    left = corpus_pipeline.one_of_each_group(spark, corpus_pipeline.stored(poor, "poor"), "").filter("source = 'hot'")
    assert sorted(r.doc_id for r in left.collect()) == [0, 2000]


def test_repeated_words_of_overlapping_windows(spark):
    cases = ["a b c d e f g h a b c d e f g h", "x " * 9, "a b c d e f g", "p q r s t u v w z p q r s t u v w"]
    rows = spark.createDataFrame([(c.split(),) for c in cases], "words array<string>")
    assert [r.n_repeat_words for r in quality_rules.with_repeated_words(rows.coalesce(1)).collect()] == [16, 9, 0, 16]


def test_language_id(spark):
    docs = frame(spark)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model, "doc_id", "source").collect()}
    assert len(got) == len({r[0] for r in texts()}) and model.languages == ["a", "b"]
    for i in (501, 502, 503, 508, 509):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    right = [got[r[0]].lang_pred == r[2] for r in texts() if r[0] is not None and r[0] < 500]
    assert sum(right) >= 0.9 * len(right) and all(0 <= r.score <= 1 for r in got.values())
    empty = langid.fit(frame(spark, []))
    assert {r.lang_pred for r in langid.predict(docs, empty, "doc_id").collect()} == {"und"}
    assert langid.predict(frame(spark, []), model, "doc_id").count() == 0


def test_maximal_segments_are_those_of_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.integers(-4, 4, rng.integers(1, 14)).astype(float)
        cumulative = np.concatenate([[0.0], np.cumsum(scores)])
        got = toxicity.segments(cumulative, np.flatnonzero(scores > 0))

        def split(a, b):
            """The best segment of scores[a:b], then the same to its left and right."""
            found = [(cumulative[j] - cumulative[i], -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
            if not found or max(found)[0] <= 0:
                return []
            s, _, _, i, j = max(found)
            return split(a, i) + [s] + split(j, b)

        assert sorted(s for *_, s in got) == sorted(split(0, len(scores)))


def test_toxicity_finds_passages(spark):
    rows = [(i, t + (" you scumbag moron" if i % 4 == 0 else ""), None, None) for i, (_, t, *_) in enumerate(texts(1) * 8) if t and len(t) < 2000]
    labelled = frame(spark, rows).withColumn("toxic", (F.col("doc_id") % 4 == 0).cast("int"))
    model = toxicity.fit(labelled)
    asked = frame(spark, [(1, "tion ing moron scumbag ing tion", None, None), (2, "tion ing ver", None, None), (3, None, None, None), (4, "", None, None)])
    got = {r.doc_id: r for r in toxicity.score(asked, model, "doc_id").collect()}
    assert [got[i].predicted for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [(p.first_word, p.last_word) for p in got[1].passages] == [(2, 3)] and got[3].passages == []
    none = toxicity.fit(labelled.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.score(asked, none, "doc_id").collect()} == {0}
    assert toxicity.score(frame(spark, []), model, "doc_id").count() == 0


def test_language_model_base_and_distribution(spark):
    docs = frame(spark)
    training = docs.filter("coalesce(doc_id, 1) % 5 <> 0")
    counts = maxent_lm.token_counts(training)
    words = maxent_lm.vocabulary(counts)
    weights = maxent_lm.train(training, words)
    got = maxent_lm.score(docs.withColumn("body", F.col("text")), counts, words, weights, "doc_id", "body").collect()
    seen = collections.Counter()
    for i, t, *_ in texts():
        if (1 if i is None else i) % 5:
            seen.update([*tokens(t), b" "])
    total = sum(seen.values())
    for r in got:
        every = [*tokens(r.body), b" "]
        base = sum(math.log10((seen[t] + 0.1) / (total + 0.1 * (len(seen) + 1))) for t in every)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(every), sum(seen[t] > 0 for t in every), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and r.score < 0
    # Classes and words within them sum to one, and so do a rare class's shares with one unseen word.
    at = np.zeros(1, np.int32)
    *_, p, _, _, _, q = maxent_lm._forward(at, at, at, words, weights)
    assert np.isclose(p.sum(), 1, atol=1e-5) and np.isclose(q.sum(), 1, atol=1e-5)
    share = maxent_lm.vocabulary(counts).rare_mass.sum() - 0.1 * maxent_lm.RARE
    rest = sorted(seen.values(), reverse=True)[maxent_lm.HEAD:]
    assert np.isclose(share, sum(n + 0.1 for n in rest), atol=1e-6)


def test_language_model_without_training_texts(spark):
    counts = maxent_lm.token_counts(frame(spark, []))
    words = maxent_lm.vocabulary(counts)
    got = maxent_lm.score(frame(spark), counts, words, maxent_lm.train(frame(spark, []), words), "doc_id").collect()
    assert all(abs(r.base_score) < 1e-6 and abs(r.score) < 1e-6 and r.n_known == 0 for r in got)


def test_bpe_round_trip_matches_the_tokenizer_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    docs = frame(spark, texts() + [(900, "<|endoftext|> it's 12½  \n\n x\x85\xa0y \x1c z\r\n", None, None)])
    encoded = bpe.encode(docs, RANKS, P.PATTERN, "doc_id", "source")
    got = bpe.decode(encoded.join(docs.select("doc_id", "text"), "doc_id"), RANKS, "doc_id", "text", "ids").collect()
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_streaming_decode_holds_back_unfinished_characters():
    text = "aé日😀z" * 3
    machine = bpe.Utf8Stream()
    assert "".join([machine.feed(bytes([b])) for b in text.encode()] + [machine.close()]) == text
    machine = bpe.Utf8Stream()
    assert machine.feed("é".encode()[:1]) == "" and machine.close() == "�"


def test_transducer_emits_before_the_end():
    machine = bpe.Transducer(RANKS)
    piece = b" " + b"abcdefg hijk" * 30
    state, emitted = machine.START, []
    for byte in piece:
        state, out = machine.step(state, byte)
        emitted += out
    assert len(b"".join(machine.token[t] for t in emitted)) > 0.8 * len(piece)
    assert [*emitted, *machine.finish(state)] == bpe.merge_all(piece, RANKS) == machine.encode(piece)


def test_mixing_gives_targets_to_the_word(spark):
    rows = frame(spark).withColumn("origin", F.col("source"))
    got = mixing.mix(rows, "origin").collect()
    assert len(got) == len(texts())
    assert collected(mixing.mix(rows, "origin"), "*") == sorted((tuple(r) for r in got), key=repr)
    size = collections.Counter()
    taken, target = collections.Counter(), {}
    for r in got:
        size[r.origin] += r.size
        taken[r.origin] += r.taken
        target[r.origin] = r.target
        assert r.taken <= 3 * r.size
    assert math.isclose(sum(target.values()), sum(size.values()))
    weight = {s: i % 3 + 1 for i, s in enumerate(["s0", "s1", "s2", None])}
    open_ = [s for s in target if target[s] < 3 * size[s] - 1e-6]
    assert max(target[s] / weight[s] for s in open_) - min(target[s] / weight[s] for s in open_) < 1e-6
    for s in target:
        assert taken[s] == math.floor(target[s] + 1e-6) and target[s] <= 3 * size[s] + 1e-6
    assert mixing.mix(frame(spark, [])).count() == 0


def test_mixing_schedule_is_spread_evenly(spark):
    rows = [(i, "w " * 3000, None, "abc"[i % 3]) for i in range(60)]
    placed, sources = mixing.sized(frame(spark, rows))
    slots = mixing.schedule(placed, sources).filter("slot IS NOT NULL").groupBy("slot", "source").agg(F.sum("part_words").alias("w")).collect()
    order = [r.source for r in sorted(slots, key=lambda r: r.slot)]
    share = {s: order.count(s) / len(order) for s in "abc"}
    for n in range(20, len(order), 20):
        for s in "abc":
            assert abs(order[:n].count(s) - n * share[s]) <= math.log2(len(order)) + 1


def test_crc_of_ids_is_that_of_their_text(spark):
    from campanile.llm.sample import crc

    got = collected(frame(spark).filter("doc_id IS NOT NULL").select("doc_id", crc().alias("crc")), "doc_id", "crc")
    assert all(c == zlib.crc32(str(i).encode()) for i, c in got)


def test_license_scan_of_spellings_lines_and_whole_texts(spark):
    rows = [(1, "Copyright (c) 2020 Me\nReleased  under the MIT LICENCE", None, None), (2, "/* (C) x */\n* licensed under the apache license, v2.0", None, None),
            (3, "word word\nAll rights reserved.\nall rights reserved\nReleased under the MIT License.", None, None),
            (4, "MIT", None, None), (5, "", None, None), (6, None, None, None), (None, "All rights reserved.", None, None), (4, "MIT", None, None)]
    got = collected(license_scan.scan(frame(spark, rows)), "doc_id", "text_license", "line_licenses")
    assert got == sorted([(1, "MIT", ["MIT"]), (2, "Apache-2.0", ["Apache-2.0"]), (3, None, ["MIT", "Proprietary"]), (4, None, []), (4, None, []),
                          (5, None, []), (6, None, []), (None, "Proprietary", ["Proprietary"])], key=repr)
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_quality_verdicts_may_be_filtered(spark):
    judged = quality_rules.judge(frame(spark))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    for condition in ("kept", "NOT base_failed", "n_words > 5"):
        assert size(judged.filter(condition)) < 2 * size(judged), condition
    whole = judged.select("doc_id", "kept", "base_failed").collect()
    assert judged.filter("kept").count() == sum(r.kept for r in whole)
    assert judged.filter("NOT base_failed").count() == sum(not r.base_failed for r in whole)


def test_segments_take_linear_time():
    """Hits with as much neutral text between them: each candidate starts lower than all before it."""
    def looks(n):
        scores = np.tile([1.0, -2.0], n)
        places = CountingList(np.concatenate([[0.0], np.cumsum(scores)]))
        assert len(toxicity.segments(places, np.arange(0, 2 * n, 2))) == n
        return places.seen

    class CountingList(list):
        seen = 0

        def __getitem__(self, i):
            self.seen += 1
            return list.__getitem__(self, i)

    assert looks(4000) == 2 * looks(2000)
    start = time.process_time()
    rising = np.tile([-1.0, 0.5], 50_000)
    assert len(toxicity.segments(np.concatenate([[0.0], np.cumsum(rising)]), np.arange(1, 100_000, 2))) == 50_000
    up = np.tile([1.0, -0.5], 50_000)
    assert toxicity.segments(np.concatenate([[0.0], np.cumsum(up)]), np.arange(0, 100_000, 2)) == [(0, 99_998, 25_000.5)]
    assert time.process_time() - start < 5


def test_rows_without_toxic_ones_are_those_that_score_clean(spark):
    rows = [(i, f"nice day number{i % 5} " + ("vile scum slur " * 3 if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(80)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(labelled)
    docs = spark.createDataFrame([*[(i, t, "x") for i, t, _ in rows], (None, None, "x"), (1, "", "y")], "doc_id bigint, text string, score string")
    clean = toxicity.score(docs, model, "doc_id").filter("predicted = 0").count()
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == clean == 62


def test_the_decoder_holds_back_unfinished_characters():
    token = bpe.tokens_by_rank(RANKS)
    rng = random.Random(1)
    alphabet = [0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0x41, 0xED, 0xA0]
    for _ in range(400):
        data = bytes(rng.choice([rng.randrange(256), *alphabet]) for _ in range(rng.randint(0, 12)))
        ids = [RANKS[data[i:i + 1]] for i in range(len(data))]
        machine, decoder = bpe.Utf8Stream(), bpe.StreamDecoder(token)
        text, given = "", b""
        for i in range(0, len(ids), 3):
            text += machine.feed(data[i:i + 3])
            given += decoder.feed(ids[i:i + 3])
            assert given == data[:len(given)] and len(data[:i + 3]) - len(given) < 4
        assert text + machine.close() == data.decode("utf-8", "replace") == "".join(bpe.decode_stream(ids, token))
        assert given + decoder.close() == data


def test_copies_of_one_text_are_sent_once_a_batch(spark):
    import pyarrow as pa

    hot = " ".join(f"hot{i}" for i in range(40))
    other = [" ".join(words(random.Random(i), 40)) for i in range(600)]
    rows = [(i, hot if i % 3 == 0 else other[i % 600], None, None) for i in range(1800)]
    block = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    sent = pa.Table.from_batches(list(jaccard_join._send([block], 5, 4)))
    numbers = [n for n in sent.column("number").to_pylist() if n is not None]
    assert sum(map(len, numbers)) == 8 * len({r[1] for r in rows})  # one number for each set, not for each document
    got = collected(jaccard_join.jaccard_components(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    first = {}
    for i, text, *_ in rows:
        first.setdefault(text, i)
    assert got == sorted(((i, 36, first[text]) for i, text, *_ in rows), key=repr)


def test_tokens_of_whole_characters_do_not_move_the_decoder():
    token = bpe.tokens_by_rank(RANKS)
    decoder = bpe.StreamDecoder(token)
    ids = [RANKS[b" the"], RANKS["é".encode()], RANKS["日".encode()[:1]], RANKS["日".encode()[1:2]], RANKS["日".encode()[2:]], RANKS[b" the"]]
    assert decoder.feed(np.array(ids[:4])) == " theé".encode() and decoder.feed(ids[4:]) == "日 the".encode() and decoder.close() == b""
    assert sorted(k >> 3 for k in decoder._moves) == sorted(ids[2:5])


def test_the_encoder_and_the_decoder_get_blocks_of_bounded_bytes(spark):
    import pyarrow as pa

    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(cast(id as string), 2500)").alias("text"))
    decoded = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, "doc_id"), RANKS, "doc_id", "ids")
    # Ids reach the decoder once.
    assert decoded.columns == ["doc_id", "ids", "decoded"] and "kept_ids" not in decoded._jdf.queryExecution().toString()
    sizes = docs.mapInArrow(lambda blocks: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in blocks), "n bigint")
    assert max(r.n for r in sizes.collect()) < 9 << 20
