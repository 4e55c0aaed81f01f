"""Operators on texts against brute force, on nulls, long texts, ties and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from decimal import Decimal
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from comparison import connect, difference, rows_of_spark, rows_of_sql
from llm.frames import BASE, LONG, ROWS, documents, listed
from pyspark.sql import functions as F

from monthloom.llm import chat, common, decontamination, language, mixing, near_duplicates, recurrent, token_counts, token_files, toxicity
from monthloom.llm.catalog import BYTES, ORACLES, PIECES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    found = rows_of_spark(QUERIES[name](spark, SMALL))
    assert difference(found, rows_of_sql(connect(SMALL), ORACLES[name])) is None


def test_token_counts_are_the_librarys(spark):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    found = {(r["doc_id"], r["n_bytes"]): r for r in token_counts.count_tokens(documents(spark), PIECES, limit=5).collect()}
    for doc_id, text, _, _ in ROWS:
        r = found[doc_id, len((text or "").encode())]
        assert r["n_tokens"] == len(model.encode(text or ""))
        assert r["over_limit"] == (r["n_tokens"] > 5)
        assert len(model.encode((text or "")[: r["fitting_chars"]])) <= 5
    assert token_counts.count_tokens(documents(spark, []), PIECES).count() == 0


def test_every_prefix():
    from sentencepiece import SentencePieceProcessor

    model, counter = SentencePieceProcessor(model_file=PIECES), token_counts.counter(PIECES)
    dice = random.Random(3)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "<s>", "▁", "①", "\t", "12", ",", "...", "漢", "😀", "\x00", "tion", "=="]
    for _ in range(300):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(0, 10)))
        assert counter.counts(text) == [len(model.encode(text[:k])) for k in range(len(text) + 1)]
        table, limit = counter.table(text), dice.randint(0, 6)
        longest = max(k for k, n in enumerate(counter.counts(text)) if n <= limit)
        assert counter.fitting(table, limit) == longest


def _sets(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def _expected_components(rows):
    sets = [(i, _sets(t)) for i, t in rows]
    least = {i: i for i, _ in rows if i is not None}
    for _ in range(len(rows)):
        for i, a in sets:
            for j, b in sets:
                if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    return sorted(((i is not None, i or 0, len(s), least.get(i)) for i, s in sets), key=str)


def test_near_duplicates_by_hand(spark):
    found = near_duplicates.near_duplicates(documents(spark))
    rows = sorted(((r[0] is not None, r[0] or 0, r[1], r[2]) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert rows == _expected_components([(i, t) for i, t, _, _ in ROWS])
    assert {r["doc_id"]: r["kept"] for r in found.collect()}[8] is False
    assert near_duplicates.near_duplicates(documents(spark, [])).count() == 0


def test_large_groups_of_near_copies_and_shared_passages(spark):
    dice = random.Random(11)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(5))
    passage, base = [word() for _ in range(60)], [word() for _ in range(150)]
    rows = []
    for k in range(420):
        own = list(base)
        for _ in range(dice.randint(0, 4)):
            own[dice.randrange(len(own))] = word()
        rows.append((k, " ".join(own)))
    rows += [(k, " ".join([word() for _ in range(70)] + passage + [word() for _ in range(70)])) for k in range(420, 620)]
    frame = documents(spark, [(i, t, None, None) for i, t in rows])
    sets = {i: _sets(t) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            least[i] = least[least[i]]
            i = least[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids[: ids.index(i)]:
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    assert listed(near_duplicates.near_duplicates(frame), "doc_id", "component_id") == [(i, root(i)) for i in ids]


def test_documents_on_one_template_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 64)
    monkeypatch.setattr(near_duplicates, "SMALL", 16)
    gathered, in_arrow = [], near_duplicates.in_arrow

    def spied(frame, function, schema):
        if function is near_duplicates._across:
            gathered.append(frame.agg(F.max(F.size("members"))).first()[0] or 0)
        return in_arrow(frame, function, schema)

    monkeypatch.setattr(near_duplicates, "in_arrow", spied)
    template, rows = [f"t{k}" for k in range(80)], []
    for k in range(130):
        rows.append((k, " ".join(template + [f"d{k}w{j}" for j in range(30)])))
    rows += [(200 + k, rows[3 * k][1] + " and more") for k in range(30)]
    frame = documents(spark, [(i, t, None, None) for i, t in rows])
    expected = [(i, 3 * (i - 200) if i >= 200 else i) for i, _ in rows]
    assert listed(near_duplicates.near_duplicates(frame), "doc_id", "component_id") == expected
    assert max(gathered) <= 64 + 16


@pytest.mark.parametrize("family", [None, 0])
def test_a_family_of_many_parts_is_compared_once(spark, monkeypatch, family):
    monkeypatch.setattr(near_duplicates, "BLOCK", 64)
    monkeypatch.setattr(near_duplicates, "SMALL", 16)
    if family is not None:  # larger families branch
        monkeypatch.setattr(near_duplicates, "FAMILY", family)
    branched, in_arrow = [], near_duplicates.in_arrow

    def spied(frame, function, schema):
        if schema.startswith("node long, cid long, part long, family long"):
            branched.append(frame.count())
        return in_arrow(frame, function, schema)

    monkeypatch.setattr(near_duplicates, "in_arrow", spied)
    dice, rows = random.Random(5), []
    base = own = [f"b{k}" for k in range(120)]
    for k in range(160):
        own = list(own if k % 2 else base)  # every second is a near copy of the one before
        for n in range(1 if k % 2 else dice.randint(2, 3)):
            own[dice.randrange(len(own))] = f"o{k}n{n}"
        rows.append((k, " ".join(own)))
    frame = documents(spark, [(i, t, None, None) for i, t in rows])
    sets, least = [_sets(t) for _, t in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            low, high = sorted((least[i], least[j]))
            least = [low if x == high else x for x in least]
    found = listed(near_duplicates.near_duplicates(frame), "doc_id", "component_id")
    assert found == list(enumerate(least)) and len(set(least)) > 20
    assert (sum(branched) > len(rows)) == (family == 0)


def test_branched_sets_are_computed_once(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SMALL", 4)
    made = spark.sparkContext.accumulator(0)
    children, saved, large = near_duplicates._children, near_duplicates.saved, []

    def counted(depth):
        def run(batches):
            for batch in children(depth)(batches):
                made.add(batch.num_rows)
                yield batch

        return run

    def watched(frame):
        kept = saved(frame)
        if kept.columns[-1] == "side":
            large.append(kept.filter(f"outside > {near_duplicates.SMALL}").count())
        return kept

    monkeypatch.setattr(near_duplicates, "_children", counted)
    monkeypatch.setattr(near_duplicates, "saved", watched)
    rng = np.random.default_rng(4)
    sketches = rng.integers(0, 3, (400, near_duplicates.TOKENS), dtype=np.uint8)
    rows = [(node, k, k, k, bytearray(sketches[k].tobytes())) for node in (1, 2) for k in range(400)]
    nodes = spark.createDataFrame(rows, "node long, cid long, part long, family long, sketch binary")
    near_duplicates._branching(nodes).collect()
    # A set goes to one child or two; the last nodes branch no more.
    assert 0 < made.value <= 2 * sum(large[:-1])
    assert sum(large[:-1]) <= made.value


def test_no_words_stay_in_a_worker():
    near_duplicates.shingles(LONG.encode())
    assert not [k for k, v in vars(near_duplicates).items() if isinstance(v, dict) and b"w1x1" in v]


def test_sketches_hardly_reject_pairs_at_the_threshold():
    n, agree = near_duplicates.TOKENS, 0.75 + 0.25 / 256
    fewest = math.ceil(near_duplicates.LEAST_AGREEMENT * n)
    assert sum(math.comb(n, k) * agree**k * (1 - agree) ** (n - k) for k in range(fewest)) < 1e-4


def test_languages(spark):
    found = QUERIES["op4_language"](spark, SMALL).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)


def test_languages_of_odd_texts(spark):
    found = language.identify(documents(spark), PIECES).collect()
    assert len(found) == len(ROWS)
    letters = {i for i, t, _, _ in ROWS if t and any(c.isalpha() for c in t)}
    assert all((r["lang_pred"] != "und") == (r["doc_id"] in letters) for r in found if r["doc_id"] is not None)
    unlabelled = documents(spark, [(1, BASE, None, None)])
    assert [tuple(r) for r in language.identify(unlabelled, PIECES).collect()] == [(1, False, "und", 0.0)]
    assert language.identify(documents(spark, []), PIECES).count() == 0


def test_forward_sums_all_segmentations():
    rows = {"▁a": (0.5,), "▁": (0.25,), "a": (0.5,), "b": (0.125,), "ab": (0.0625,), "▁ab": (0.03125,)}
    total = 0.5 * 0.125 + 0.25 * 0.5 * 0.125 + 0.25 * 0.0625 + 0.03125
    assert np.isclose(np.exp(language.forward("ab", rows, (1e-7,), 3)[0]), total)
    ids = {p: k for k, p in enumerate(rows)}
    expected: Counter = Counter()
    language.expected_counts("ab", 2.0, ids, 3, np.array([v[0] for v in rows.values()] + [1e-7]), expected)
    assert np.isclose(expected[ids["▁ab"]], 2 * 0.03125 / total)


def _exact(word, rows, unknown):
    """Sum over all segmentations, in decimals of any size, and expected counts of the pieces."""
    text, size = "▁" + word, len(word) + 1
    longest = max(map(len, rows))
    paths = [[(s, text[s:e], Decimal(rows.get(text[s:e], unknown))) for s in range(max(0, e - longest), e) if text[s:e] in rows or s == e - 1] for e in range(1, size + 1)]
    alpha, beta, found = [Decimal(1)] + [Decimal(0)] * size, [Decimal(0)] * size + [Decimal(1)], Counter()
    for e in range(1, size + 1):
        alpha[e] = sum(alpha[s] * p for s, _, p in paths[e - 1])
    for e in range(size, 0, -1):
        for s, piece, p in paths[e - 1]:
            beta[s] += beta[e] * p
            if piece in rows:
                found[piece] += alpha[s] * p * beta[e] / alpha[size]
    return alpha[size], found


def test_new_words_are_summed_side_by_side(monkeypatch):
    pieces = ["▁a", "▁ab", "a", "b", "ab", "ba", "bab", "é", "▁漢字", "字"]
    ids = {piece: k for k, piece in enumerate(pieces)}
    table = np.random.default_rng(5).random((len(ids) + 1, 3)) / len(ids)
    rows, unknown = {piece: tuple(table[k]) for piece, k in ids.items()}, tuple(table[-1])
    words = ["a", "b", "x", "ab", "abab", "babab", "éab", "漢字", "漢字字", "xyz", "ab" * 12, "ab" * 12 + "a", "ba" * 40]
    expected = [language.forward(w, rows, unknown, 3) for w in words]
    slow, forward = [], language.forward
    monkeypatch.setattr(language, "forward", lambda w, *more: slow.append(w) or forward(w, *more))
    for limit in (400, 6):
        scorer = language.Scorer(ids, table, limit)
        scorer.prepare([words[:5], words[5:], []])
        assert [scorer.score([w]).tolist() for w in words] == expected
        assert np.allclose(scorer.score(words * 2), 2 * np.sum(expected, axis=0))
    assert {len(w) for w in slow} == {25, 80}


@pytest.mark.parametrize("size", [language.PLAIN_LETTERS, language.PLAIN_LETTERS + 1, 70, 10_000])
def test_long_words_are_summed_whole(size):
    first = {"▁": 0.25, "▁a": 0.01, "a": 0.002, "b": 0.1, "ab": 0.004, "bca": 1e-5, "ccc": 2e-8}
    rows = {piece: (p, 1e-8, p / 3) for piece, p in first.items()}
    word = "".join(random.Random(size).choices("abcd", k=size))  # no piece has a d
    assert language.words(f"{word}, {word}") == [word, word]
    found = language.forward(word, rows, (1e-7,) * 3, 3)
    for k in range(3):
        total, counts = _exact(word, {piece: row[k] for piece, row in rows.items()}, 1e-7)
        assert math.isclose(found[k], float(total.ln()), rel_tol=1e-9)
        ids, expected = {piece: i for i, piece in enumerate(rows)}, Counter()
        language.expected_counts(word, 2.0, ids, 3, [row[k] for row in rows.values()] + [1e-7], expected)
        for piece, i in ids.items():
            assert math.isclose(expected[i], 2 * float(counts[piece]), rel_tol=1e-6, abs_tol=1e-12), piece


def _unigrams(rows):
    training = Counter(w for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10 for w in recurrent.tokens((t or "").encode()))
    n, v = sum(training.values()), len(training)
    return {(i, t): (sum(training[w] > 0 for w in recurrent.tokens((t or "").encode())), n, sum(np.log10((training[w] + 0.1) / (n + 0.1 * (v + 1))) for w in recurrent.tokens((t or "").encode()))) for i, t in rows}


def test_recurrent_scores(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "DICTIONARY", 300)  # so that rarer words are joined
    expected = _unigrams([(i, t) for i, t, _, _ in ROWS])
    found = recurrent.score_texts(documents(spark), sample=5, rounds=1).collect()
    assert len(found) == len(ROWS)
    for r in found:
        near = [e for (i, t), e in expected.items() if i == r["doc_id"] and len(recurrent.tokens((t or "").encode())) == r["n_tokens"]]
        assert any(e[:2] == (r["n_known"], r["train_tokens"]) and np.isclose(e[2], r["base_score"]) for e in near)
        assert r["score"] < 0
    assert recurrent.score_texts(documents(spark, [])).count() == 0


def test_recurrent_model_beats_unigrams_on_held_out_texts(spark):
    found = [r for r in QUERIES["op5_recurrent"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_all_training_rows_train_the_network(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "VOCABULARY", 8)
    seen, limits, in_arrow, initial = [], [], recurrent.in_arrow, recurrent.Network.initial

    def spied(frame, function, schema):
        if function.__name__ == "run" and schema.startswith("name"):
            seen.append(frame.count())
        return in_arrow(frame, function, schema)

    monkeypatch.setattr(recurrent, "in_arrow", spied)
    monkeypatch.setattr(recurrent.Network, "initial", staticmethod(lambda counts: limits.append(len(counts)) or initial(counts)))
    rows = [(k, f"w{k % 40} x{k % 7} y", None, None) for k in range(2_500)]
    recurrent.score_texts(documents(spark, rows), rounds=2).count()
    training = sum(zlib.crc32(str(k).encode()) % 10 != 0 for k in range(2_500))
    assert seen == [training] * 2
    assert limits == [min(49, int((4 * training) ** 0.5) - 1) + 1]


def test_network_is_a_distribution_with_right_gradients():
    dice, n = np.random.default_rng(1), 130
    p = {k: v.astype(np.float64) for k, v in recurrent.Network.initial(np.arange(n, 0, -1.0)).items()}
    network = recurrent.Network(p)
    h = dice.standard_normal((1, recurrent.WIDTH))
    assert np.isclose(np.exp(network.log_probabilities(np.repeat(h, n, axis=0), np.arange(n))).sum(), 1)
    inputs, targets = dice.integers(0, n, (2, 4)), dice.integers(0, n, (2, 4))
    fresh, real = np.zeros((2, 4), bool), np.ones((2, 4), bool)
    fresh[:, 0] = fresh[1, 2] = True
    h0 = np.zeros((2, recurrent.WIDTH))

    def loss(q):
        m, state, out = recurrent.Network(q), h0, 0.0
        for t in range(4):
            state = m.step(np.where(fresh[:, t, None], 0, state), m.inputs[inputs[:, t]])[0]
            out -= m.log_probabilities(state, targets[:, t]).sum()
        return out / 8

    slopes, _ = network.gradients(h0, inputs, targets, fresh, real)
    for name, slope in slopes.items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert np.isclose((loss(up) - loss(down)) / 2e-5, slope[at], rtol=1e-3, atol=1e-6)


def _shard(n_words, lengths, seed=3):
    dice = np.random.default_rng(seed)
    p = recurrent.Network.initial(np.arange(n_words, 0, -1.0) ** 2)
    return p, [dice.zipf(1.3, size) % n_words for size in lengths]


@pytest.mark.parametrize("columns, padded, together", [(1024, (4, 16), 65_536), (7, (1, 2), 50)])
def test_scores_of_texts_are_those_of_single_steps(monkeypatch, columns, padded, together):
    for name, value in (("COLUMNS", columns), ("PADDED", padded), ("TOGETHER", together)):
        monkeypatch.setattr(recurrent, name, value)
    p, texts = _shard(200, [1, 90, 3, 70, 33])
    p = {name: value.astype(np.float64) * (1.0 if name == "o" else 3.0) for name, value in p.items()}
    network, expected = recurrent.Network(p), []
    for text in texts:
        h, previous, total = np.zeros((1, recurrent.WIDTH)), 5, 0.0
        for symbol in text:
            h = network.step(h, network.inputs[[previous]])[0]
            logits, (c, k) = (h @ p["C"] + p["c"])[0], divmod(symbol, recurrent.CLASS_WORDS)
            own = (h @ p["O"][c] + p["o"][c])[0]
            total += logits[c] - np.log(np.exp(logits).sum()) + own[k] - np.log(np.exp(own).sum())
            previous = symbol
        expected.append(total)
    assert np.allclose(network.score(texts, 5), expected)
    assert network.score([], 5).tolist() == []


def test_probabilities_stay_right_where_exponentials_leave_the_range():
    p, _ = _shard(100, [])
    p["c"], p["o"] = p["c"] + np.float32(500), p["o"] - np.float32(500)
    found = recurrent.Network(p).log_probabilities(np.zeros((100, recurrent.WIDTH), np.float32), np.arange(100))
    assert np.isclose(np.exp(found).sum(), 1, rtol=1e-3)


@pytest.mark.parametrize("columns, padded, moved", [(1024, (4, 16), 16_384), (9, (2, 5), 100)])
def test_training_takes_the_steps_of_plain_adam(monkeypatch, columns, padded, moved):
    for name, value in (("COLUMNS", columns), ("PADDED", padded), ("MOVED", moved), ("STREAMS", 3)):
        monkeypatch.setattr(recurrent, name, value)
    p, texts = _shard(150, [400, 45, 300, 2, 290])  # a stream for each of the three long ones, the others after the shortest
    streams = [[texts[0]], [texts[2]], [texts[4], texts[1], texts[3]]]
    expected, first, second = {k: v.astype(np.float64) for k, v in p.items()}, {k: 0.0 for k in p}, {k: 0.0 for k in p}
    sizes, h = [400, 300, 337], np.zeros((3, recurrent.WIDTH))
    for n, at in enumerate(range(0, 400, recurrent.STEPS), 1):
        rows = [k for k in range(3) if sizes[k] > at]
        window = [np.zeros((len(rows), recurrent.STEPS), kind) for kind in (int, int, bool, bool)]
        for i, k in enumerate(rows):
            symbols = [(5 if j == 0 else t[j - 1], t[j], j == 0, True) for t in streams[k] for j in range(len(t))][at : at + recurrent.STEPS]
            for j, values in enumerate(symbols):
                for array, value in zip(window, values):
                    array[i, j] = value
        slopes, h[rows] = recurrent.Network(expected).gradients(h[rows], *window)
        norm = math.sqrt(sum((g * g).sum() for g in slopes.values()))
        for name, g in slopes.items():
            g = g * min(1.0, 1.0 / norm)
            first[name], second[name] = first[name] * 0.9 + 0.1 * g, second[name] * 0.99 + 0.01 * g * g
            expected[name] = expected[name] - 0.01 * (first[name] / (1 - 0.9**n)) / (np.sqrt(second[name] / (1 - 0.99**n)) + 1e-6)
    found = recurrent.train(p, texts, 5)
    assert sorted(found) == sorted(p)
    for name, value in found.items():
        assert value.dtype == np.float32 and np.allclose(value, expected[name], atol=2e-3), name


def test_adam_goes_on_after_many_steps():
    dice = np.random.default_rng(2)
    p = dice.standard_normal((3, 4)).astype(np.float32)
    adam, plain, first, second = recurrent.Adam(p), p.astype(np.float64), 0.0, 0.0
    for n in range(1, 600):
        rows = np.flatnonzero(dice.random(3) < 0.5)
        g = np.zeros((3, 4))
        g[rows] = dice.standard_normal((len(rows), 4))
        first, second = first * 0.9 + 0.1 * g * 0.5, second * 0.99 + 0.01 * (g * 0.5) ** 2
        plain -= 0.01 * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.99**n)) + 1e-6)
        adam.step(g[rows].astype(np.float32), 0.5, 0.01, rows)
    assert np.allclose(p, plain, atol=1e-3)


def test_texts_are_encoded_as_their_tokens():
    texts = [b"  A b\tc\n", b"x", None, b"", b" \x0b\x0c ", "É\u2003q\x1cw b".encode() + b"\xff\x85 \xc2", b"a a zz b", b"  "]
    for words in ([b"a", recurrent.END, b"b", b"zz"], [b"a", b"b"], []):
        known, logs, most = {w: k for k, w in enumerate(words)}, np.arange(1, len(words) + 1) * 1.5, min(2, len(words))
        found = recurrent.encode(pa.array([b"first", *texts], pa.binary())[1:], pa.array(words, pa.binary()), logs, most)
        for k, text in enumerate(texts):
            ids = [known.get(w, -1) for w in recurrent.tokens(text)]
            symbols = np.array([i + 1 if 0 <= i < most else 0 for i in ids], recurrent.symbol_kind(most + 1))
            rare = [w for w, i in zip(recurrent.tokens(text), ids) if i < 0]
            expected = (len(ids), sum(i >= 0 for i in ids), symbols.tolist().count(0), sum(logs[i] for i in ids if i >= 0), sum(logs[i] for i in ids if i >= most), rare, symbols.tobytes())
            assert tuple(column[k].as_py() for column in found) == expected
    assert (recurrent.symbol_kind(65_536), recurrent.symbol_kind(65_537)) == (np.uint16, np.int32)


def test_texts_are_read_twice_and_the_driver_gets_each_parameter_once(spark, monkeypatch):
    read, sent, sizes, in_arrow, initial = [], [], [], recurrent.in_arrow, recurrent.Network.initial

    def spied(frame, function, schema):
        read.append("text" in frame.columns)
        out = in_arrow(frame, function, schema)
        if schema.startswith("name"):
            sent.append(out)
        return out

    monkeypatch.setattr(recurrent, "in_arrow", spied)
    monkeypatch.setattr(recurrent.Network, "initial", staticmethod(lambda counts: sizes.append(sum(v.size for v in initial(counts).values())) or initial(counts)))
    recurrent.score_texts(documents(spark), rounds=1).count()
    assert sum(read) == 2  # for the counts and for the symbols
    assert [sum(len(r["value"]) for r in sent[-1].collect())] == [4 * size for size in sizes]


def _contamination(text, items):
    words = decontamination.words_of((text or "").encode())
    hit, found = set(), set()
    for item, body in items:
        own = decontamination.words_of((body or "").encode())
        size = min(13, len(own))
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(words) - size + 1):
            if size and tuple(words[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_words", [100_000, 10])
def test_decontamination_by_hand(spark, block_words, monkeypatch):
    monkeypatch.setattr(decontamination.match_items, "__defaults__", (block_words,))
    dice = random.Random(5)
    text = lambda n: " ".join(dice.choice("abcd") for _ in range(n))
    items = [(k, text(dice.choice([1, 2, 5, 12, 13, 14, 20]))) for k in range(4, 24)] + [(1, BASE), (2, None), (3, "  "), (None, "lazy DOG"), (9, "dark-wood")]
    rows = [*ROWS, *((100 + k, text(dice.randint(0, 60)), None, None) for k in range(150))]
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, spans string")
    found = decontamination.contamination(documents(spark, rows), bench)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert listed(found, *names) == sorted(
        ((i, *_contamination(t, items)) for i, t, _, _ in rows), key=lambda r: tuple((x is not None, x) for x in r)
    )


def test_spans_are_cut(spark):
    filler = " ".join(f"f{k}" for k in range(400))
    rows = [(1, f"{filler}. {BASE}! {filler}", None, None), (2, BASE, None, None), (3, None, None, None)]
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in decontamination.remove_spans(documents(spark, rows), bench).collect()}
    assert cut == {1: f"{filler}. ! {filler}", 3: None}
    assert decontamination.contamination(documents(spark, []), bench).count() == 0
    assert decontamination.contamination(documents(spark), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(token_files.build_index, "__defaults__", (4,))
    library = Tokenizer.from_file(BYTES)
    folder = str(tmp_path / "out")
    places = token_files.encode_to_files(documents(spark), BYTES, 2, folder)
    rows = {(r["doc_id"], r["copy"]): r for r in places.collect()}
    ids = {(r["doc_id"], r["copy"]): r["ids"] for r in token_files.read_ids(token_files.locate(places.select("doc_id", "copy"), folder), folder, True).collect()}
    assert len(rows) == len(ROWS)
    left = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _, _ in ROWS]
    at = 0
    for key in sorted(rows, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        own = list(ids[key])
        left.remove((key[0], own))
        assert (rows[key]["start"], rows[key]["n_tokens"]) == (at, len(own))
        assert rows[key]["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        at += len(own)
    assert not left
    other = spark.createDataFrame([(777, 0), (1, 5)], "doc_id long, copy long")
    assert token_files.locate(other, folder).filter("shard is not null").count() == 0
    assert token_files.encode_to_files(documents(spark, []), BYTES, 2).count() == 0


def test_no_encoder_stays_when_texts_are_encoded(spark, tmp_path, monkeypatch):
    functions, in_arrow = {}, token_files.in_arrow
    monkeypatch.setattr(token_files, "in_arrow", lambda frame, f, schema: functions.update({f.__name__: f}) or in_arrow(frame, f, schema))
    token_files.write_ids(documents(spark), BYTES, 2, str(tmp_path / "files"))
    token_files.encoder(BYTES).encode("some words")
    assert list(functions["blocks"](iter([]))) == []
    assert token_files.encoder.cache_info().currsize == 0


def test_memory_freed_by_arrow_is_given_back(spark, monkeypatch):
    class Frame:
        sparkSession = spark
        mapInArrow = staticmethod(lambda function, schema: function)

    given = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: given.append(1)})())
    assert list(common.in_arrow(Frame(), iter, "x long")([1, 2])) == [1, 2]
    assert given == [1]


def test_runs_are_what_the_library_splits():
    e = token_files.Encoder(BYTES)
    dice = random.Random(8)
    parts = ["a", "The", " ", "  ", "\n", "\t", "\xa0", "　", "\x1c", "\x85", "é", "'s", "'ll", "12", "!", "?!", "<|endoftext|>", "漢", "😀", "\r\n", "½", "(", "Ø", "×"]
    for _ in range(4_000):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(0, 12)))
        assert np.frombuffer(e.encode(text), e.kind).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_remembered_once():
    e = token_files.Encoder(BYTES)
    text = "plain words stand alone, caf\u00e9 na\u00efve (twice) twice"
    assert e.encode(text) == e._ids(text) and e.encode(text + "\n\t " + text) == e._ids(text + "\n\t " + text)
    assert not {p for p in e.parts if token_files.WORD.fullmatch(p)} & {f" {w}" for w in e.spaced if token_files.WORD.fullmatch(w)}


def test_uneven_white_space_by_definition():
    pattern = re.compile(f"[{token_files.SPACE}](?:[{token_files.SPACE}]|$)|^ |[^\\S \\n]")
    for k in range(3):
        for text in map("".join, product(["a", "\u00e9", " ", "\n", "\t", "\x1f", "\xa0", "\u3000"], repeat=k + 1)):
            assert token_files.uneven(text) == bool(pattern.search(text))


def test_perfect_hash():
    keys = np.random.default_rng(2).integers(0, 2**63, 20_000, dtype=np.uint64)
    h = token_files.PerfectHash.from_bytes(token_files.PerfectHash.build(keys).to_bytes())
    assert sorted(h.numbers(keys).tolist()) == list(range(len(keys)))
    assert len(h.to_bytes()) * 8 < 4 * len(keys)


def test_mixing(spark):
    rows = [(k, f"t{k}", None, "big" if k % 3 else "small") for k in range(3_000)] + [(None, None, None, None), (7, "again", None, "small")]
    frame = documents(spark, rows)
    mixed = mixing.mix_sources(frame, weights={"big": 1.0, "small": 3.0}, budget=6_000)
    share = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(share["big"] - 1_500) < 150 and abs(share["small"] - 4_500) < 250 and None not in share
    assert mixed.columns[:3] == ["doc_id", "text", "lang"] and "n_tokens" in mixed.columns
    again = mixing.mix_sources(frame.repartition(5), weights={"big": 1.0, "small": 3.0}, budget=6_000)
    assert listed(mixed, "doc_id", "copy", "shuffle_key") == listed(again, "doc_id", "copy", "shuffle_key")
    many = mixing.mix_sources(frame, weights={None: 1.0}, budget=500.0).collect()
    assert 380 < len(many) < 620 and {r["doc_id"] for r in many} == {None}
    assert mixing.mix_sources(documents(spark, [])).count() == 0


def _all_segments(scores):
    """The definition: the best segment, then the same on both sides of it."""
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, a, b = best
    return [*_all_segments(scores[:a]), (a, b), *[(a + 0 + b - a + x, b + y) for x, y in _all_segments(scores[b:])]]


def test_segments_by_definition():
    dice = random.Random(4)
    for _ in range(300):
        scores = [dice.choice([-3.0, -1.0, -0.5, 1.0, 2.0, 4.0]) + dice.random() / 100 for _ in range(dice.randint(0, 12))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(scores))] == _all_segments(scores)


def test_toxicity(spark):
    found = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(p for p, t in held if t) >= 0.8 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.02 * sum(not t for _, t in held)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (6, None, "x"), (None, 1, "x"), (9, 0, "x")], "doc_id long, toxic int, score string")
    odd = toxicity.score_toxicity(documents(spark), labels).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score_toxicity(documents(spark, []), labels).count() == 0
    assert toxicity.score_toxicity(documents(spark), labels.limit(0)).filter("predicted = 1").count() == 0


def test_snapshots(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", None),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", ""),
        (4, 5, "user", "hi"), (4, 5, "user", "hi"),
        (None, 0, None, "lost"), (6, 0, "user", "hi"), (7, 0, "user", " same "), (8, 0, "user", " same "),
    ]
    frame = spark.createDataFrame([(*t, 1, "p") for t in turns], "conv_id long, turn long, role string, text string, position int, h1 string")
    kept = chat.collapse_snapshots(frame)
    assert {r["conv_id"]: r["n_copies"] for r in kept.collect()} == {2: 1, 3: 1, 4: 1, None: 1, 7: 2}
    one = sorted((r["position"], r["rendered"]) for r in kept.collect() if r["conv_id"] == 7)
    assert one == [(1, "<|im_start|>user\nsame<|im_end|>\n")]
    assert chat.collapse_snapshots(frame.limit(0)).count() == 0


def test_vocabulary_files_are_parameters():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES and LONG
