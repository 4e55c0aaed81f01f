"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import in_arrow, remainder, saved

#: Documents of each language that a model is fitted on, on average; all of a rarer one.
SAMPLE = 2_000
#: Rounds of expectation and maximisation.
ROUNDS = 3
#: Added to the expected count of every piece.
SMOOTHING = 0.05
#: Log-probability of a character that is in no piece.
UNKNOWN = math.log(1e-7)
LETTERS = re.compile(r"[^\W\d_]+")
#: Words of more letters are summed in logarithms: products of so many probabilities don't underflow.
PLAIN_LETTERS = 24


@cache
def pieces(model_file: str) -> dict[str, int]:
    """Lower-cased pieces of a public vocabulary without bytes and controls, numbered."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    found = {
        model.id_to_piece(i).lower()
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    return {p: k for k, p in enumerate(sorted(p for p in found if p.strip("▁") and all(c.isalpha() for c in p.lstrip("▁"))))}


def words(text: str) -> list[str]:
    """Runs of letters in lower case, of any length."""
    return LETTERS.findall(text.lower())


def has_letter(found: list[str]) -> bool:
    return any(any(map(str.isalpha, w)) for w in found)


def arcs(word: str, ids: dict[str, int], longest: int) -> list[list[tuple[int, int]]]:
    """For each end, the (start, piece) pairs of pieces that end there; -1 is no piece."""
    marked, out = "▁" + word, []
    for end in range(1, len(marked) + 1):
        here = [
            (start, ids[marked[start:end]]) for start in range(max(0, end - longest), end) if marked[start:end] in ids
        ]
        if not any(start == end - 1 for start, _ in here):
            here.append((end - 1, -1))
        out.append(here)
    return out


def forward(word: str, rows: dict[str, tuple[float, ...]], unknown: tuple[float, ...], longest: int) -> list[float]:
    """Log-probability of a word in each language: the sum over all its segmentations."""
    if len(word) > PLAIN_LETTERS:
        return log_forward(word, rows, unknown, longest)
    marked = "▁" + word
    alpha: list = [(1.0,) * len(unknown)]
    for end in range(1, len(marked) + 1):
        one = rows.get(marked[end - 1 : end], unknown)
        total = [a * p for a, p in zip(alpha[end - 1], one)]
        for start in range(max(0, end - longest), end - 1):
            row = rows.get(marked[start:end])
            if row:
                total = [t + a * p for t, a, p in zip(total, alpha[start], row)]
        alpha.append(total)
    return [math.log(max(a, 1e-300)) for a in alpha[-1]]


def log_forward(word: str, rows: dict[str, tuple[float, ...]], unknown: tuple[float, ...], longest: int) -> list[float]:
    """``forward`` in logarithms, for words of any length: keeps the last ``longest`` sums only.

    Each language has a scale of its own, the largest of the sums it adds.
    """
    marked = "▁" + word
    recent = [np.zeros(len(unknown))]  # of the last places, the newest last
    for end in range(1, len(marked) + 1):
        first = end - len(recent)
        found = [(recent[-1], rows.get(marked[end - 1 : end], unknown))]
        for start in range(first, end - 1):
            row = rows.get(marked[start:end])
            if row:
                found.append((recent[start - first], row))
        sums = np.array([a for a, _ in found]) + np.log(np.array([row for _, row in found]))
        top = sums.max(axis=0)
        recent.append(top + np.log(np.exp(sums - top).sum(axis=0)))
        del recent[:-longest]
    return recent[-1].tolist()


def log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(x - top) for x in terms))


def log_expected_counts(word: str, n: float, ids: dict[str, int], longest: int, p: Sequence[float], into: dict[int, float]) -> None:
    """``expected_counts`` in logarithms, for words of any length."""
    lattice = [[(start, token, math.log(p[token])) for start, token in here] for here in arcs(word, ids, longest)]
    alpha = [0.0]
    for here in lattice:
        alpha.append(log_sum([alpha[start] + x for start, _, x in here]))
    leaving: list[list[float]] = [[] for _ in range(len(alpha))]  # by place, what goes on from it to the end
    leaving[-1].append(0.0)
    for end in range(len(alpha) - 1, 0, -1):
        beta = log_sum(leaving[end])
        for start, token, x in lattice[end - 1]:
            leaving[start].append(beta + x)
            if token >= 0:
                into[token] += n * math.exp(alpha[start] + x + beta - alpha[-1])


def expected_counts(word: str, n: float, ids: dict[str, int], longest: int, p: Sequence[float], into: dict[int, float]) -> None:
    """Adds the expected number of times each piece is used in ``n`` occurrences of a word."""
    if len(word) > PLAIN_LETTERS:
        return log_expected_counts(word, n, ids, longest, p, into)
    lattice, size = arcs(word, ids, longest), len(word) + 1
    alpha, beta = [0.0] * (size + 1), [0.0] * (size + 1)
    alpha[0] = beta[size] = 1.0
    for end, here in enumerate(lattice, 1):
        alpha[end] = sum(alpha[start] * p[token] for start, token in here)
    for end in range(size, 0, -1):
        for start, token in lattice[end - 1]:
            beta[start] += beta[end] * p[token]
    for end, here in enumerate(lattice, 1):
        for start, token in here:
            if token >= 0:
                into[token] += n * alpha[start] * p[token] * beta[end] / alpha[size]


def sample(documents: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of training rows: all of a language, or a part chosen by a hash of the id."""
    known = documents.filter("lang is not null and text is not null").filter(remainder("doc_id", 5) != 0)
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).select(F.col("lang").alias("of"), "n")
    chance = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), F.lit(1_000_000)) / 1e6
    return (
        known.select("doc_id", "lang", "text")
        .join(sizes, F.col("lang") == F.col("of"))
        .filter(chance * F.col("n") < per_language)
        .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    )


def _word_counts(batches):
    counts: dict[tuple[str, str], int] = defaultdict(int)

    def rows():
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(counts.values(), pa.int64())],
            names=["lang", "word", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word in words(text.decode("utf-8", "replace")):
                counts[lang, word] += 1
        if len(counts) > 300_000:
            yield rows()
            counts.clear()
    yield rows()


def fit(documents: DataFrame, model_file: str, per_language: int = SAMPLE, rounds: int = ROUNDS):
    """(languages, piece probabilities [pieces + 1, languages]; the last row is an unknown character).

    Each round sums expected piece counts over the word counts of each language; what comes
    to the driver is at most one number for each piece and language.
    """
    counts = saved(
        in_arrow(sample(documents, per_language), _word_counts, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return [], None
    size, place = len(pieces(model_file)), {lang: k for k, lang in enumerate(languages)}
    table = np.full((size + 1, len(languages)), 1.0 / size)
    table[-1] = math.exp(UNKNOWN)
    for _ in range(rounds):
        shared = documents.sparkSession.sparkContext.broadcast(table)
        sums = np.zeros((size, len(languages)))
        expected = in_arrow(counts, _expectation(shared, place, model_file), "lang string, piece int, n double")
        for r in expected.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            sums[r["piece"], place[r["lang"]]] = r["n"]
        sums += SMOOTHING
        table = np.vstack([sums / sums.sum(axis=0), np.full(len(languages), math.exp(UNKNOWN))])
    return languages, table


def _expectation(shared, place, model_file):
    def run(batches):
        ids, table = pieces(model_file), shared.value
        longest = max(map(len, ids))
        sums: dict[str, dict[int, float]] = {lang: defaultdict(float) for lang in place}
        own = {lang: table[:, k].tolist() for lang, k in place.items()}
        for batch in batches:
            for lang, word, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                expected_counts(word, n, ids, longest, own[lang], sums[lang])
        for lang, found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(found.values(), pa.float64())],
                names=["lang", "piece", "n"],
            )

    return run


class Lattice:
    """Forward sums of many words side by side: a trie of the pieces is walked from all places at once.

    Sums are those of ``forward``, added in the same order.
    """

    def __init__(self, ids: dict[str, int], table: np.ndarray) -> None:
        states: dict[str, int] = {"": 0}
        edges: dict[int, int] = {}
        for piece in ids:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in states:
                    states[piece[:end]] = len(states)
                    edges[states[piece[: end - 1]] << 21 | ord(piece[end - 1])] = states[piece[:end]]
        keys, into = np.array([*edges], np.int64), np.array([*edges.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.into = keys[order], into[order]
        self.piece = np.full(len(states), -1, np.int64)
        for piece, k in ids.items():
            self.piece[states[piece]] = k
        self.longest, self.table = max(map(len, ids)), table

    def arcs(self, words: list[str], sizes: np.ndarray):
        """For each length of pieces: word, end and piece of the arcs, by end."""
        chars = np.frombuffer("".join([f"▁{w}" for w in words]).encode("utf-32-le"), "<u4").astype(np.int64)
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(words)), sizes)
        begin = np.arange(len(chars)) - first[owner]
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        for length in range(1, self.longest + 1):
            keep = begin[at] + length <= sizes[owner[at]]
            at, state = at[keep], state[keep]
            key = state << 21 | chars[at + length - 1]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            at, state = at[hit], self.into[place[hit]]
            piece = self.piece[state]
            found = at[piece >= 0]
            end = begin[found] + length
            order = np.argsort(end, kind="stable")
            yield owner[found][order], end[order], piece[piece >= 0][order]

    def forward(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language, one row a word."""
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        words = [words[k] for k in order]
        sizes = np.array([len(w) + 1 for w in words])
        longest = int(sizes[0])
        reach = len(words) - np.cumsum(np.bincount(sizes, minlength=longest + 1))  # words of more characters
        arcs = []
        for owner, end, piece in self.arcs(words, sizes):
            arcs.append((owner, piece, np.searchsorted(end, np.arange(longest + 2)).tolist()))
        alpha = np.ones((longest + 1, len(words), self.table.shape[1]))
        for end in range(1, longest + 1):
            n = int(reach[end - 1])
            one = np.full(n, len(self.table) - 1)
            owner, piece, bounds = arcs[0]
            one[owner[bounds[end] : bounds[end + 1]]] = piece[bounds[end] : bounds[end + 1]]
            total = alpha[end - 1, :n] * self.table[one]
            for length in range(min(end, self.longest), 1, -1):
                owner, piece, bounds = arcs[length - 1]
                if bounds[end] < bounds[end + 1]:
                    own = owner[bounds[end] : bounds[end + 1]]
                    total[own] += alpha[end - length, own] * self.table[piece[bounds[end] : bounds[end + 1]]]
            alpha[end, :n] = total
        sums = np.maximum(alpha[sizes, np.arange(len(words))], 1e-300)
        out = np.empty_like(sums)
        out[order] = np.array([math.log(x) for x in sums.ravel().tolist()]).reshape(sums.shape)
        return out


class Scorer:
    """Log-probabilities of remembered words, one row each."""

    #: Words that are summed side by side.
    TOGETHER = 8_192

    def __init__(self, ids: dict[str, int], table: np.ndarray, limit: int = 400_000) -> None:
        self.known = {piece: tuple(table[k].tolist()) for piece, k in ids.items()}
        self.unknown, self.limit = tuple(table[-1].tolist()), limit
        self.longest = max(map(len, ids))
        self.lattice = Lattice(ids, table)
        self.rows: dict[str, int] = {}
        self.values = np.empty((limit, table.shape[1]))

    def learn(self, new: list[str]) -> None:
        """Remembers words that are not remembered yet; there is room for them."""
        rows, values = self.rows, self.values
        plain = [w for w in new if len(w) <= PLAIN_LETTERS]
        for at in range(0, len(plain), self.TOGETHER):
            part = plain[at : at + self.TOGETHER]
            values[len(rows) : len(rows) + len(part)] = self.lattice.forward(part)
            rows.update(zip(part, range(len(rows), len(rows) + len(part))))
        for w in new:
            if len(w) > PLAIN_LETTERS:
                values[len(rows)] = forward(w, self.known, self.unknown, self.longest)
                rows[w] = len(rows)

    def prepare(self, texts: list[list[str]]) -> None:
        """Learns the new words of several texts at once, if they can be remembered together."""
        every = set().union(*texts)
        new = [w for w in every if w not in self.rows]
        if len(self.rows) + len(new) > self.limit:
            if len(every) > self.limit:
                return
            self.rows.clear()
            new = list(every)
        self.learn(new)

    def score(self, found: list[str]) -> np.ndarray:
        """Sum over the words; of more than can be remembered at once, part by part."""
        total = np.zeros(self.values.shape[1])
        rows, values = self.rows, self.values
        for at in range(0, len(found), self.limit // 2):
            part = found[at : at + self.limit // 2]
            try:
                places = np.fromiter(map(rows.__getitem__, part), dtype=np.int64, count=len(part))
            except KeyError:
                new = {w for w in part if w not in rows}
                if len(rows) + len(new) > self.limit:
                    rows.clear()
                    new = set(part)
                self.learn(list(new))
                places = np.fromiter(map(rows.__getitem__, part), dtype=np.int64, count=len(part))
            total += values[places].sum(axis=0)
        return total


_SCORERS: dict[str, Scorer] = {}


def scorer_of(key: str, model_file: str, table: np.ndarray) -> Scorer:
    """The scorer of the last model, with what it remembers, for all tasks of a worker."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(pieces(model_file), table)
    return _SCORERS[key]


def identify(documents: DataFrame, model_file: str, per_language: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is the language with the largest sum of word log-probabilities, ``score`` its
    share among the languages (a posterior with equal priors); ties go to the first in order.
    Null texts and texts without a letter are ``und`` with score 0, and so is everything where
    no row has a language. Only texts enter a prediction; rows of null lang are predicted, not
    learned from. Repeated rows count each. An empty table gives no rows. Texts and words of any
    length are scored whole. Other columns are ignored.
    """
    languages, table = fit(documents, model_file, per_language, rounds)
    shared = documents.sparkSession.sparkContext.broadcast((languages, table))
    key = uuid.uuid4().hex
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        names, probabilities = shared.value
        scorer = scorer_of(key, model_file, probabilities) if names else None
        for batch in batches:
            labels, scores = [], []
            texts = [words(raw.decode("utf-8", "replace")) if raw else [] for raw in batch.column(1).to_pylist()]
            if names:
                scorer.prepare(texts)
            for found in texts:
                if not names or not has_letter(found):
                    labels.append("und")
                    scores.append(0.0)
                    continue
                total = scorer.score(found)
                best = int(np.argmax(total))
                labels.append(names[best])
                scores.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    scored = in_arrow(
        documents.select("doc_id", F.col("text").cast("binary").alias("text")), run,
        f"doc_id {kind}, lang_pred string, score double",
    )
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
