"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import Memo, in_arrow, remainder
from monthloom.llm.decontamination import words_of

#: Labelled rows a model is fitted on at most; of more, those of the smallest hashes.
MAX_LABELS = 50_000
#: Tokens and stems a model keeps at most, those with the largest z-score.
MAX_TOKENS = 50_000
#: Least z-score of a token that counts.
LEAST_Z = 3.5
#: Weight of the Dirichlet prior, in tokens of the whole training text.
PRIOR = 200.0
#: Score of a token without a weight: segments end where toxic words get rare.
DRIFT = -0.25
#: A segment is significant below this chance of a clean text of the length having one.
ALPHA = 0.01
#: Bytes of a stem; a token without a weight takes its stem's.
STEM = 5


@dataclass(frozen=True)
class Model:
    tokens: dict[bytes, float]
    scale: float  # lambda of the extreme-value law
    log_k: float
    weights: tuple[float, ...]  # of the logistic calibration


def stem(word: bytes) -> bytes:
    return b"^" + word[:STEM]


def token_score(tokens: dict[bytes, float], word: bytes) -> float:
    value = tokens.get(word)
    return tokens.get(stem(word), DRIFT) if value is None else value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, score), in one pass over the positive tokens.

    Candidates are kept as (from, to, sum before, sum through, last candidate with a smaller
    sum before); each is merged at most once, so the scan is linear.
    """
    if not len(scores):
        return []
    total = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    found: list[tuple[int, int, float, float, int]] = []
    for at, upto in zip(places.tolist(), total[places].tolist()):
        start, end, before = at, at + 1, upto - float(scores[at])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= upto:
                found.append((start, end, before, upto, j))
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, through - before) for a, b, before, through, _ in found]


def training_rows(documents: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled documents that are not held out."""
    chosen = (
        labels.filter("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").alias("toxic"))
        .filter(remainder("label_id", 4) != 2)
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(limit)
    )
    text = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    # At most ``limit`` pairs of numbers.
    return text.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", F.col("toxic").cast("int").alias("toxic"))


def _count(batches):
    """For each token: clean and toxic documents with it, and 64-bit sets of its preceding words."""
    counts: dict[bytes, list[int]] = {}

    def rows():
        signed = lambda k: [v[k] - (1 << 64) if v[k] >> 63 else v[k] for v in counts.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.binary()), *(pa.array(signed(k), pa.int64()) for k in range(4))],
            names=["token", "clean", "toxic", "clean_before", "toxic_before"],
        )

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            label, before = int(toxic > 0), b""
            seen: dict[bytes, int] = defaultdict(int)
            for word in words_of(text):
                bit = 1 << (zlib.crc32(before) & 63)
                seen[word] |= bit
                seen[stem(word)] |= bit
                before = word
            for token, bits in seen.items():
                own = counts.setdefault(token, [0, 0, 0, 0])
                own[label] += 1
                own[label + 2] |= bits
            if len(counts) > 300_000:
                yield rows()
                counts.clear()
    yield rows()


def token_weights(train: DataFrame) -> tuple[dict[bytes, float], float]:
    """Log-odds of toxic against clean of the tokens and stems that differ significantly, and lambda.

    A token counts once a document, and no oftener than it follows different words: so a
    passage that is copied into many documents counts like one. (The number of different
    words is estimated from 64 bits; where those are nearly full, documents count.) The prior
    of a token is its share of the training text times PRIOR, half a token at least. Lambda
    solves ``sum of p * exp(lambda * score) = 1`` over the clean tokens.
    """
    counts = in_arrow(train, _count, "token binary, clean long, toxic long, clean_before long, toxic_before long").groupBy("token").agg(
        *(F.sum(c).alias(c) for c in ("clean", "toxic")), *(F.bit_or(c).alias(c) for c in ("clean_before", "toxic_before"))
    )
    bits = lambda c: F.bit_count(f"{c}_before")
    contexts = lambda c: F.round(-64 * F.log(1 - F.least(bits(c), F.lit(63)) / 64))
    fair = lambda c: F.when(bits(c) >= 58, F.col(c).cast("double")).otherwise(F.least(F.col(c).cast("double"), contexts(c)))
    counts = counts.select("token", *(fair(c).alias(c) for c in ("clean", "toxic")))
    totals = counts.groupBy((F.substring("token", 1, 1) == F.lit(b"^")).alias("stem")).agg(F.sum("clean"), F.sum("toxic"))
    sums = {r[0]: (r[1] or 0.0, r[2] or 0.0) for r in totals.collect()}
    n_clean, n_toxic = sums.get(False, (0.0, 0.0))
    if not n_clean or not n_toxic:
        return {}, 1.0
    prior = F.greatest((F.col("clean") + F.col("toxic")) * F.lit(PRIOR / (n_clean + n_toxic)), F.lit(0.5))
    rate = lambda c, n: F.log((F.col(c) + prior) / F.greatest(F.lit(n + PRIOR) - F.col(c) - prior, F.lit(1e-9)))
    scored = counts.filter("clean + toxic >= 3").withColumn("odds", rate("toxic", n_toxic) - rate("clean", n_clean)).withColumn(
        "z", F.col("odds") / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    )
    best = scored.filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "token").limit(MAX_TOKENS)
    rows = best.select("token", "odds", "clean").collect()
    tokens = {bytes(r["token"]): min(r["odds"], 0.0) + DRIFT if r["odds"] < 0 else r["odds"] for r in rows}
    p = np.array([(r["clean"] + 0.5) / n_clean for r in rows if not bytes(r["token"]).startswith(b"^")])
    s = np.array([tokens[bytes(r["token"])] for r in rows if not bytes(r["token"]).startswith(b"^")])
    low, high = 0.05, 5.0
    for _ in range(60):
        scale = (low + high) / 2
        mass = float(np.sum(p * np.exp(scale * s))) + max(0.0, 1 - float(p.sum())) * math.exp(scale * DRIFT)
        low, high = (scale, high) if mass < 1 else (low, scale)
    return tokens, (low + high) / 2


def features(best: float, total: float, n_significant: int) -> list[float]:
    return [1.0, min(best, 60.0) / 10, math.log1p(min(max(total, 0.0), 1e4)), math.log1p(n_significant)]


def _evidence(words, memo, scale, log_k):
    """Significant segments with their calibrated scores, and the features of the text.

    A segment's calibrated score is ``lambda * score - ln(K * length)``, for which a clean text
    of the length exceeds x with a chance of 1 - exp(-exp(-x)).
    """
    scores = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
    offset = log_k + math.log(max(len(words), 1))
    least = -math.log(-math.log1p(-ALPHA))
    found = [(a, b, scale * s - offset) for a, b, s in segments(scores)]
    strong = [x for x in found if x[2] >= least]
    best = max((x[2] for x in found), default=-10.0)
    return strong, features(max(best, -10.0), sum(x[2] for x in strong), len(strong))


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> Model:
    """Token weights, extreme-value law and calibration from labelled rows of the training folds."""
    train = training_rows(documents, labels, limit)
    tokens, scale = token_weights(train)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(tokens)

    def extremes(batches):
        memo = Memo(lambda word: token_score(shared.value, word))
        for batch in batches:
            best, n, toxic, sums = [], [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                scores = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
                found = [s for _, _, s in segments(scores)]
                best.append(max(found, default=0.0))
                sums.append(sorted(found, reverse=True)[:200])
                n.append(len(words))
                toxic.append(int(label > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(best), pa.array(n, pa.int64()), pa.array(toxic, pa.int32()), pa.array(sums, pa.list_(pa.float64()))],
                names=["best", "n", "toxic", "sums"],
            )

    rows = in_arrow(train, extremes, "best double, n long, toxic int, sums array<double>").collect()
    # K such that a share ALPHA of the clean texts has a significant segment.
    least = -math.log(-math.log1p(-ALPHA))
    clean = [scale * r["best"] - math.log(max(r["n"], 1)) for r in rows if not r["toxic"]]
    log_k = float(np.quantile(clean, 1 - ALPHA)) - least if clean else 0.0
    x, y = [], []
    for r in rows:
        calibrated = [scale * s - log_k - math.log(max(r["n"], 1)) for s in r["sums"]]
        strong = [s for s in calibrated if s >= least]
        x.append(features(max([-10.0, *calibrated]), sum(strong), len(strong)))
        y.append(r["toxic"])
    return Model(tokens, scale, log_k, logistic(np.array(x).reshape(-1, 4), np.array(y, dtype=float)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Weights of a ridge logistic regression by Newton steps; without labels all are zero but the first."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[0] = -5.0 if not len(y) or y[0] == 0 else 5.0
        return tuple(w.tolist())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def score_toxicity(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELS, threshold: float = 0.3) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted, passages.

    ``passages`` are the significant segments as [from, to) word numbers with their
    calibrated scores. Only texts enter a score. Null and empty texts have no segment and get
    the score that fits. Documents without label are scored like the others; of contradictory
    labels toxic counts; repeated rows are scored each. Without labels of both kinds scores are
    constant. An empty table gives no rows; other columns are ignored.
    """
    model = fit(documents, labels, limit)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    passages = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))

    def run(batches):
        m = shared.value
        memo = Memo(lambda word: token_score(m.tokens, word))
        for batch in batches:
            scores, found = [], []
            for text in batch.column(1).to_pylist():
                strong, x = _evidence(words_of(text), memo, m.scale, m.log_k)
                margin = sum(a * b for a, b in zip(x, m.weights))
                scores.append(1 / (1 + math.exp(-min(max(margin, -500), 500))))
                found.append([{"start": a, "end": b, "bits": s} for a, b, s in strong])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, passages)], names=["doc_id", "score", "passages"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = in_arrow(
        documents.select("doc_id", F.col("text").cast("binary").alias("text")), run,
        f"doc_id {kind}, score double, passages array<struct<start int, end int, bits double>>",
    )
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "passages",
    )
