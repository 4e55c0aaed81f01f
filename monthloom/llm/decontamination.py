"""Benchmark decontamination by a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import in_arrow, saved

#: Words in a window; an item of fewer is one window.
WINDOW = 13
#: Benchmark words of one automaton. More items are matched block by block.
BLOCK_WORDS = 100_000

#: ASCII letters lower-cased, other ASCII but digits made blank: words are what is left.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences.

    ``windows[s]``: items with a window of WINDOW words that ends in state s or below it in
    the chain of suffix links; ``short[s]``: (length, item) of whole shorter items that are
    suffixes of what state s stands for.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]]) -> None:
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in words]) for item, words in items if words]
        for _, sequence in coded:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        n = len(self.next)
        own_windows: list[set] = [set() for _ in range(n)]
        own_short: list[list] = [[] for _ in range(n)]
        for item, sequence in coded:
            state, most = 0, min(WINDOW, len(sequence))
            for k, word in enumerate(sequence):
                state = self.next[state][word]
                while self.length[self.link[state]] >= most and self.link[state] > 0:
                    state = self.link[state]
                if k + 1 >= most:
                    if most == WINDOW:
                        own_windows[state].add(item)
                    else:
                        own_short[state].append((most, item))
        self.windows, self.short = own_windows, own_short
        for state in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[up] >= WINDOW:
                own_windows[state] = own_windows[up]
            if own_short[up]:
                own_short[state] = own_short[state] + own_short[up]
        self.least = min((min(WINDOW, len(s)) for _, s in coded), default=0)
        pairs = {a * len(self.ids) + b for _, s in coded for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            old = nxt[last][word]
            if length[old] == length[last] + 1:
                return old
            return self._split(last, word, old)
        state = self._new({}, 0, length[last] + 1)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = state
            at = link[at]
        if at >= 0:
            old = nxt[at][word]
            link[state] = old if length[old] == length[at] + 1 else self._split(at, word, old)
        return state

    def _new(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: int, old: int) -> int:
        half = self._new(dict(self.next[old]), self.link[old], self.length[at] + 1)
        self.link[old] = half
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = half
            at = self.link[at]
        return half

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Merged spans [from, to) of hit words, and the items whose windows occur."""
        spans: list[list[int]] = []
        found: set = set()
        if len(words) < self.least or not self.least:
            return spans, found
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        # Only runs of word pairs that some item has can hold a window of two words or more.
        if self.least > 1:
            places = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            codes = ids[places] * len(self.ids) + ids[places + 1]
            slots = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            places = places[self.pairs[slots] == codes]
        else:
            places = np.flatnonzero(ids >= 0)
        if not len(places):
            return spans, found
        reach = 2 if self.least > 1 else 1
        cuts = np.flatnonzero(np.diff(places) > 1)
        starts = places[np.r_[0, cuts + 1]]
        ends = places[np.r_[cuts, len(places) - 1]] + reach
        keep = ends - starts >= self.least
        nxt, link, length = self.next, self.link, self.length
        for start, end in zip(starts[keep].tolist(), ends[keep].tolist()):
            state = matched = 0
            for k, word in enumerate(ids[start:end].tolist(), start + 1):
                while state and word not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if word in nxt[state]:
                    state = nxt[state][word]
                    matched += 1
                hit = 0
                if matched >= WINDOW:
                    hit = matched
                    found |= self.windows[state]
                for size, item in self.short[state]:
                    if size <= matched:
                        hit = max(hit, size)
                        found.add(item)
                if hit:
                    _add(spans, k - hit, k)
        return spans, found


def _add(spans: list[list[int]], start: int, end: int) -> None:
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


MATCHES = "doc_id {id}, text binary, n_words long, spans array<array<int>>, items array<string>"


def match_items(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text as UTF-8, n_words, spans, items) of every document.

    ``spans`` are the merged [from, to) word ranges inside windows, ``items`` the ids of the
    items whose windows occur. Items are split into blocks of about ``block_words`` words, so
    an automaton never exceeds a bound; the documents pass one block after the other.

    Null or empty texts have no words and no hits; null items never match; an item with null
    id hits but is not listed; repeated rows are documents of their own; an empty benchmark
    leaves every document without hits. Other columns are ignored.
    """
    items = benchmark.filter("text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("body")
    )
    size = items.agg(F.sum(F.length("body"))).first()[0] or 0
    n_blocks = max(1, -(-size // (2 * block_words)))  # a word takes two bytes at least
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = MATCHES.format(id=kind)
    out = documents.select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<array<int>>) spans"), F.expr("cast(array() as array<string>) items"),
    )
    for block in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == block).collect()
        shared = documents.sparkSession.sparkContext.broadcast([(r[0], bytes(r[1])) for r in rows])
        if block:
            out = saved(out)
        out = in_arrow(out, _matcher(shared), schema)
    return out


def _matcher(shared):
    def run(batches):
        automaton = Automaton([(item, words_of(body)) for item, body in shared.value])
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            for text, spans, items in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4))):
                words = words_of(text)
                more, found = automaton.match(words)
                n_words.append(len(words))
                all_spans.append(_merged(spans + more) if spans else more)
                all_items.append(sorted({*items, *(x for x in found if x is not None)}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
                    pa.array(all_spans, pa.list_(pa.list_(pa.int32()))), pa.array(all_items, pa.list_(pa.string())),
                ],
                names=batch.schema.names,
            )

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: some word is hit, and at least one in ``share`` of them.
    """
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.element_at(s, 2) - F.element_at(s, 1))
    return (
        match_items(documents, benchmark)
        .withColumn("n_hit", hits)
        .select(
            "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_spans(text: bytes | None, spans: list[list[int]], longest: int) -> bytes | None:
    """The text without hit spans of over ``longest`` words."""
    if text is None or not any(b - a > longest for a, b in spans):
        return text
    places = [m.span() for m in WORD.finditer(text.translate(NORMAL))]
    out, at = [], 0
    for a, b in spans:
        if b - a > longest:
            out.append(text[at : places[a][0]])
            at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def remove_spans(documents: DataFrame, benchmark: DataFrame, longest: int = WINDOW, share: int = 20) -> DataFrame:
    """(doc_id, text) without hit spans of over ``longest`` words; contaminated documents go."""
    matched = match_items(documents, benchmark)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.element_at(s, 2) - F.element_at(s, 1))
    clean = matched.filter((hits == 0) | (F.lit(share) * hits < F.col("n_words")))

    def run(batches):
        for batch in batches:
            texts = [without_spans(t, s, longest) for t, s in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return in_arrow(clean, run, f"doc_id {kind}, text string")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, array_to_string(w[s : s + least(len(w), {WINDOW}) - 1], ' ') AS win, least(len(w), {WINDOW}) AS size
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, z WHERE len(w) >= size)),
h AS (SELECT doc_id, s, dw.size AS size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
n AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS k FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
