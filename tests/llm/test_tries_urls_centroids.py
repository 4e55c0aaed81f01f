"""Prefix tries, URL judgements and centroid clustering against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib

import numpy as np
import pytest
from llm.frames import listed

from monthloom.llm import centroids, prefix_trie, url_filter

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string, position string, length int, c1 string, depth string, k1 int"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], TURNS)


def plain_trie(rows):
    by_conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            by_conv.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    original = {c: [t[1:] for t in sorted(found)] for c, found in by_conv.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    nodes = {}
    for c, found in rebuilt.items():
        for d in range(len(found) + 1):
            nodes.setdefault(found[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) > len(p) and q[: len(p)] == p for q in below)]
        ends = ",".join(str(c) for c in sorted(c for c in members if rebuilt[c] == path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), len(leaves),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def many_conversations():
    dice = np.random.default_rng(5)
    rows = []
    for c in [*range(-12, 60), 101, 103, 10_000_000_002]:
        kind = int(dice.integers(0, 3))
        for k in range(int(dice.integers(1, 14))):
            rows.append((c, k, ("user", "assistant")[k % 2], f"{'é' * kind}turn {k if k < 5 else dice.integers(0, 2)}"))
    rows += [(20, None, None, None), (20, None, "user", ""), (21, 3, "user", "tie"), (21, 3, "a", "tie"), (21, 3, "a", "tie"), (None, 1, "user", "lost")]
    return rows


def test_trie_of_many_conversations(spark):
    rows = many_conversations()
    assert listed(prefix_trie.conversation_trie(turns_frame(spark, rows)), *NODE) == plain_trie(rows)


def test_trie_in_small_blocks_and_lists(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "IDS", 2)
    rows = [(c, k, "user", f"same {k}") for c in range(40) for k in range(9)] + [(50, k, "user", "long text " * 500) for k in range(40)]
    assert listed(prefix_trie.conversation_trie(turns_frame(spark, rows)), *NODE) == plain_trie(rows)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    # Short conversations whose head is another, absent one lose all their turns.
    rows = [(c, 0, "user", "a") for c in range(1, 200) if c % 5]
    expected = plain_trie(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in expected)
    assert listed(prefix_trie.conversation_trie(turns_frame(spark, rows)), *NODE) == expected
    assert prefix_trie.conversation_trie(turns_frame(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, host string, word string, n long, score string, rule int"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "w", 1, "s", 2) for r in rows], PAGES)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("https://a.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/"),
        ("https://example.net/en", "example.net", "/en", "net/"),
        ("http://net/", "net", "/", "net/"),
        ("http://a.net", "a.net", "", None),
        ("http://planet/x", "planet", "/x", None),
        ("x://b.example.com/de/a#b", "b.example.com", "/de/a", "block example.com/de/"),
        ("http://badexample.com/de/", "badexample.com", "/de/", None),
        ("http://x.org/fr/://y", "x.org", "/fr/://y", "org/fr/"),
        ("//a.net/", "", "", None),
        ("a\nb://ÄB.org?q", "Äb.org", "", None),
        ("http://", "", "", None),
        (None, "", "", None),
    ],
)
def test_places_and_rules(spark, url, host, path, rule):
    found = url_filter.located(pages_frame(spark, [(1, url, None)])).withColumn("of", url_filter.decided(url_filter.RULES)).first()
    assert (found["host"], found["path"], found["of"] and found["of"]["rule"]) == (host, path, rule and rule.split()[-1])


def plain_split(name, counts, total):
    """The most probable split, by trying all."""
    best = (-math.inf, 0)
    for cuts in itertools.product((0, 1), repeat=len(name) - 1):
        ends = [k + 1 for k, cut in enumerate(cuts) if cut] + [len(name)]
        words = [name[i:j] for i, j in zip([0, *ends], ends)]
        score = sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)
        if (score, -len(words)) > (best[0] + 1e-9, best[1]):
            best, found = (score, -len(words)), words
    return found


def test_splits(spark):
    counts = {"cheap": 40, "pills": 9, "he": 90, "pill": 12, "s": 30, "a": 80, "ab": 5, "été": 7}
    total = sum(counts.values())
    names = ["cheappills", "pillshe", "zzzz", "abab", "x", "étépills", "qcheapq"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    found = url_filter.segmented(frame, spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {r["name"]: r["words"] for r in found.collect()} == {n: plain_split(n, counts, total) for n in names}


def test_a_long_name_is_split_whole(spark):
    counts = spark.createDataFrame([("casino", 9), ("win", 9)], "word string, n long")
    frame = spark.createDataFrame([("casinowin" * 700,)], "name string")
    assert url_filter.segmented(frame, counts).first()["words"] == ["casino", "win"] * 700


def plain_ratios(sites, paths, unwanted, wanted, rounds):
    bags = [(host, w) for table in (sites, paths) for host, bag in table.items() for w in bag]
    count = {w: 0.0 for w in (*unwanted, *wanted)}
    for _, w in bags:
        count[w] = count.get(w, 0.0) + 1
    background = {w: (n + url_filter.UNSEEN) / (sum(count.values()) + url_filter.UNSEEN * len(count)) for w, n in count.items()}

    def probability(w, names, learned):
        p = (learned.get(w, 0.0) + url_filter.SMOOTHING * background[w]) / (sum(learned.values()) + url_filter.SMOOTHING)
        return url_filter.LIST_SHARE * (w in names) / len(names) + (1 - url_filter.LIST_SHARE) * p

    def ratios(u, v):
        return {w: math.log(probability(w, unwanted, u) / probability(w, wanted, v)) for w in count}

    ratio = ratios({}, {})
    for _ in range(rounds):
        share = {h: 1 / (1 + math.exp(-url_filter.PRIOR - sum(ratio[w] for w in bag))) for h, bag in sites.items()}
        u, v = {}, {}
        for host, w in bags:
            u[w], v[w] = u.get(w, 0.0) + share[host], v.get(w, 0.0) + 1 - share[host]
        ratio = ratios(u, v)
    return ratio


def test_learned_words(spark):
    sites = {"a": ["ads", "blip"], "b": ["news", "blop"], "c": ["blip", "blop"]}
    paths = {"a": ["en", "#"], "c": ["#"]}
    frame = lambda bags: spark.createDataFrame([(h, w) for h, bag in bags.items() for w in bag], "host string, word string")
    found = url_filter.learned(frame(sites), frame(paths), ["ads"], ["news", "en"], 2).collect()
    expected = plain_ratios(sites, paths, ["ads"], ["news", "en"], 2)
    assert {r["word"]: pytest.approx(r["ratio"]) for r in found} == expected


def test_judgements(spark):
    rows = [(k, f"http://www.quiet{k % 7}river.{'abcdefgh'[k % 8]}.example.com/en/{k}", "<p>quiet river the quiet</p>") for k in range(40)]
    rows += [
        (100, "http://casinobonus.example.com/en/1", "<p>"),
        (101, "http://cheappills.shop.example.com/x", None),
        (102, None, None),
        (103, "not an url", "x" * 90_000 + "<" * 50_000),
        (104, "http://casinobonus.example.com/de/1", ""),
        (105, "http://www.example.org/fr/quiet-river-casino", ""),
        (105, "http://www.example.org/fr/quiet-river-casino", ""),
        (None, "http://---/", None),
        (106, "http://" + "riverquiet" * 500 + ".example.com/" + "a/" * 3000, None),
    ]
    found = url_filter.judge_urls(pages_frame(spark, rows)).collect()
    by_id = {r["page_id"]: r for r in found}
    assert len(found) == len(rows)
    assert {r["verdict"] for r in found if r["page_id"] is not None and r["page_id"] < 40} == {"allow"}
    assert [by_id[k]["verdict"] for k in (100, 101, 102, 103, 104, 105, None, 106)] == ["block", "block", "allow", "allow", "block", "allow", by_id[None]["verdict"], "allow"]
    assert by_id[100]["host_words"] == "casino bonus example" and by_id[104]["rule"] == "example.com/de/"
    assert by_id[106]["host_words"].startswith("river quiet river quiet")
    assert url_filter.judge_urls(pages_frame(spark, [])).count() == 0


VECTORS = "vec_id long, embedding array<double>, cluster string, distance string, q int, n int, sums string, label int"
OUT = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def plain_clusters(rows, k=16, rounds=3, dimensions=64):
    kept = [(i, [math.floor(64 * x) if abs(64 * x) < 1e15 else int(x) * 64 for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centre = [v for _, v in sorted(kept, key=name)[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        of = [min(range(len(centre)), key=lambda c: (apart(v, centre[c]), c)) for _, v in kept]
        if turn < rounds:
            for c in range(len(centre)):
                own = [v for (_, v), a in zip(kept, of) if a == c]
                if own:
                    centre[c] = [sum(x) // len(own) for x in zip(*own)]
    fits = lambda d: d if d < 1 << 63 else None
    far = [apart(v, centre[a]) for (_, v), a in zip(kept, of)]
    whole = all(fits(d) is not None for d in far)
    out = []
    for (i, _), a, d in zip(kept, of, far):
        own = [x for x, b in zip(far, of) if a == b]
        out.append((i, a, fits(d), sum(own) if all(fits(x) is not None for x in own) and fits(sum(own)) is not None else None,
                    fits(sum(far)) if whole else None, hashlib.sha256(",".join(map(str, centre[a])).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "d", 1, 2, "s", 3) for i, v in rows], VECTORS)


def test_clusters(spark):
    dice = np.random.default_rng(11)
    centre = dice.standard_normal((9, 64))
    rows = [(k, (centre[k % 9] + 0.4 * dice.standard_normal(64)).tolist()) for k in range(500)]
    rows += [(600 + k, rows[k % 3][1]) for k in range(200)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    rows += [(900, None), (901, []), (902, [0.0] * 63), (903, [0.0] * 63 + [None]), (904, [math.nan] * 64), (905, [math.inf] * 64), (906, [0.0] * 64)]
    assert listed(centroids.cluster_vectors(vectors_frame(spark, rows)), *OUT) == plain_clusters(rows)


def test_clusters_of_huge_integers_of_few_vectors_and_of_none(spark):
    dice = np.random.default_rng(12)
    rows = [(k, dice.standard_normal(64).tolist()) for k in range(60)] + [(100, [1e30] * 64), (101, [-3e38] * 64), (102, [4e6] * 64), (103, [2e7] * 64)]
    assert listed(centroids.cluster_vectors(vectors_frame(spark, rows)), *OUT) == plain_clusters(rows)
    few = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.25] * 64)]
    assert listed(centroids.cluster_vectors(vectors_frame(spark, few)), *OUT) == plain_clusters(few)
    assert centroids.cluster_vectors(vectors_frame(spark, [(1, None)])).count() == 0


def test_search_leaves_centroids_out_and_loses_none():
    dice = np.random.default_rng(13)
    centre = dice.integers(-90, 90, (16, 8))
    x = centre[dice.integers(0, 16, 3000)] + dice.integers(-12, 13, (3000, 8))
    far = ((x[:, None, :] - centre[None]) ** 2).sum(axis=2)
    state = [np.zeros(3000, np.int32), np.ones(3000, np.int32), np.zeros(3000), np.zeros(3000)]
    first = centroids.shallot(x, centroids.Centres(centre.tolist(), None), *state)
    assert (state[0] == far.argmin(axis=1)).all() and first < 0.9 * far.size
    moved = centre + dice.integers(-1, 2, centre.shape)
    second = centroids.shallot(x, centroids.Centres(moved.tolist(), centre.tolist()), *state)
    assert (state[0] == ((x[:, None, :] - moved[None]) ** 2).sum(axis=2).argmin(axis=1)).all() and second < 0.3 * far.size
    # Ties go to the smaller number, wherever the search starts.
    same = np.repeat(centre[:1], 16, axis=0)
    state = [np.full(3000, 9, np.int32), np.full(3000, 4, np.int32), np.zeros(3000), np.zeros(3000)]
    centroids.shallot(x, centroids.Centres(same.tolist(), None), *state)
    assert (state[0] == 0).all()
