"""Centroid clustering in integers by Shallot search.

Vectors keep four things from round to round: their centroid, the one that was second, an upper
bound on the distance to the first and a lower bound on that to any other. Centroids move, the
bounds are widened by the moves, and where they still part no distance is computed. Where they
do not, the exact distances to first and second say which is closer; from that one the other
centroids are scanned in the order of their distance to it, inside a ball of radius (distance
to the start + distance to the second best so far) that shrinks with every better one. Bounds
are floating-point numbers with a margin and only leave centroids out; what is left is compared
in integers, ties go to the smaller number.

Only vectors that change hands add to and take from their centroids' sums, as one row a task
and centroid; the sums are exact integers of any size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import in_arrow, saved

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
#: Vectors that a task compares at once.
ROWS = 4096
#: Components below it have squared distances within 64 bits, up to 512 of them.
NARROW = 1 << 26
#: Relative error that bounds are trusted to.
MARGIN = 1e-9
LARGEST = (1 << 63) - 1
_STATE = "vec_id long, q array<double>, a int, b int, upper double, lower double, n long, sums array<string>"
_KIND = pa.schema(
    [("vec_id", pa.int64()), ("q", pa.list_(pa.float64())), ("a", pa.int32()), ("b", pa.int32()), ("upper", pa.float64()),
     ("lower", pa.float64()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]
)


def _gathered(batches):
    """Batches joined to tables of about ROWS rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


class Centres:
    """Centroids of one round with the distances between them and their last moves."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None) -> None:
        self.whole = np.array(centroids, dtype=object).reshape(len(centroids), -1)
        self.k = len(centroids)
        self.narrow = all(abs(x) < NARROW for row in centroids for x in row)
        if self.narrow:
            self.short = self.whole.astype(np.int64)
            gaps = [np.sqrt(((self.short - row) ** 2).sum(axis=1).astype(float)) for row in self.short]
            self.order = [[int(j) for j in np.argsort(g, kind="stable") if j != c] for c, g in enumerate(gaps)]
            self.gaps = gaps
        known = self.narrow and before is not None and all(abs(x) < NARROW for row in before for x in row)
        self.moves = np.sqrt(((self.short - np.array(before, np.int64)) ** 2).sum(axis=1).astype(float)) if known else None
        if known:
            # The farthest move of any other centroid.
            self.others = np.array([max((m for j, m in enumerate(self.moves) if j != c), default=0.0) for c in range(self.k)])


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x - c) ** 2).sum(axis=1)


def parted(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return upper * (1 + MARGIN) < lower * (1 - MARGIN)


def shallot(x: np.ndarray, centres: Centres, a, b, upper, lower) -> int:
    """Assign rows of ``x`` in place (a, b, upper, lower); returns how many distances it took."""
    c, computed = centres.short, 0
    if centres.k == 1:
        a[:], b[:] = 0, 0
        return 0
    if centres.moves is None:
        upper[:], lower[:] = np.inf, 0.0
    else:
        upper += centres.moves[a]
        lower -= centres.others[a]
    rest = np.flatnonzero(~parted(upper, lower))
    first = squared(x[rest], c[a[rest]])
    upper[rest] = np.sqrt(first.astype(float))
    open_ = ~parted(upper[rest], lower[rest])
    computed += len(rest)
    rest, best = rest[open_], first[open_]
    second = squared(x[rest], c[b[rest]])
    computed += len(rest)
    one, two = a[rest].copy(), b[rest].copy()
    swap = (second < best) | ((second == best) & (two < one))
    one[swap], two[swap] = two[swap], one[swap]
    best[swap], second[swap] = second[swap], best[swap]
    start, skip = one.copy(), two.copy()
    away = np.sqrt(best.astype(float))
    radius = away + np.sqrt(second.astype(float))
    for g in np.unique(start).tolist():
        rows = np.flatnonzero(start == g)
        for j in centres.order[g]:
            rows = rows[centres.gaps[g][j] * (1 - MARGIN) <= radius[rows] * (1 + MARGIN)]
            if not len(rows):
                break
            own = rows[skip[rows] != j]
            d = squared(x[rest[own]], c[j])
            computed += len(own)
            nearer = (d < best[own]) | ((d == best[own]) & (j < one[own]))
            between = ~nearer & (d < second[own])
            won, put = own[nearer], own[between]
            second[won], two[won] = best[won], one[won]
            best[won], one[won] = d[nearer], j
            second[put], two[put] = d[between], j
            radius[own] = away[own] + np.sqrt(second[own].astype(float))
    a[rest], b[rest] = one, two
    upper[rest], lower[rest] = np.sqrt(best.astype(float)), np.sqrt(second.astype(float))
    return computed


def exhaustive(x: np.ndarray, centres: Centres, a, b, upper, lower) -> None:
    """The same for integers of any size: every centroid is compared, nothing is known after it."""
    d = np.array([squared(x, row) for row in centres.whole], dtype=object)
    for r in range(len(x)):
        ranked = sorted(range(centres.k), key=lambda j: (d[j][r], j))
        a[r], b[r] = ranked[0], ranked[min(1, centres.k - 1)]
    upper[:], lower[:] = np.inf, 0.0


def integers(q: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in q], dtype=object).reshape(q.shape)


def _assign(centres: Centres, raw: bool, scale: int):
    """A round over vectors: their new state, and the changes of sums by centroid."""

    def run(batches):
        totals, counts = {}, {}

        def count(cluster, sign, rows):
            sums = [int(v) for v in rows.sum(axis=0)]
            held = totals.setdefault(cluster, [0] * len(sums))
            totals[cluster] = [s + sign * v for s, v in zip(held, sums)]
            counts[cluster] = counts.get(cluster, 0) + sign * len(rows)

        for table in _gathered(batches):
            n = table.num_rows
            q = table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float)
            if raw:
                q = np.floor(q * scale)
                a, b = np.full(n, -1, np.int32), np.full(n, min(1, centres.k - 1), np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                a, b, upper, lower = (np.array(table.column(k).to_numpy()) for k in range(2, 6))
            before = a.copy()
            a[a < 0] = 0
            small = (np.abs(q) < NARROW).all(axis=1) & centres.narrow
            for rows, work in ((np.flatnonzero(small), shallot), (np.flatnonzero(~small), exhaustive)):
                if not len(rows):
                    continue
                x = q[rows].astype(np.int64) if work is shallot else integers(q[rows])
                state = [v[rows] for v in (a, b, upper, lower)]
                work(x, centres, *state)
                for v, new in zip((a, b, upper, lower), state):
                    v[rows] = new
                moved = state[0] != before[rows]
                for cluster in np.unique(np.concatenate([state[0][moved], before[rows][moved]])).tolist():
                    if cluster >= 0:
                        for sign, side in ((1, state[0]), (-1, before[rows])):
                            chosen = moved & (side == cluster)
                            if chosen.any():
                                count(cluster, sign, x[chosen])
            lists = pa.ListArray.from_arrays(np.arange(0, q.size + 1, q.shape[1], dtype=np.int32), pa.array(q.ravel()))
            nothing = [pa.nulls(n, _KIND.field(k).type) for k in (6, 7)]
            yield from pa.table(
                [table.column(0).combine_chunks(), lists, pa.array(a), pa.array(b), pa.array(upper), pa.array(lower), *nothing], schema=_KIND
            ).to_batches(256)
        changes = [{"a": c, "n": counts[c], "sums": [str(v) for v in totals[c]]} for c in sorted(totals)]
        if changes:
            yield pa.RecordBatch.from_pylist(changes, _KIND)

    return run


def _summed(batches):
    """Changes of all tasks added up by centroid."""
    counts, totals = {}, {}
    for batch in batches:
        for c, n, sums in zip(*(batch.column(k).to_pylist() for k in range(3))):
            counts[c] = counts.get(c, 0) + n
            totals[c] = [x + int(y) for x, y in zip(totals.get(c, [0] * len(sums)), sums)]
    kind = pa.schema([("a", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])
    yield pa.RecordBatch.from_pylist([{"a": c, "n": counts[c], "sums": [str(v) for v in totals[c]]} for c in counts], kind)


def _distances(centres: Centres):
    kind = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        for table in _gathered(batches):
            n = table.num_rows
            q = table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            a = np.array(table.column(2).to_numpy())
            if centres.narrow and (np.abs(q) < NARROW).all():
                found = squared(q.astype(np.int64), centres.short[a]).tolist()
            else:
                found = [d if d <= LARGEST else None for d in squared(integers(q), centres.whole[a])]
            yield from pa.table([table.column(0).combine_chunks(), pa.array(a), pa.array(found, pa.int64())], schema=kind).to_batches(256)

    return run


def cluster_vectors(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """One row a vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dimensions`` components, none null or not finite, also after
    scaling; component x becomes floor(``scale`` * x). Centroids start as the kept vectors with
    the smallest SHA-256 of "seed:vec_id" (a null id is empty text; equal ids go by their
    components). Each round assigns every vector to the nearest centroid by squared Euclidean
    distance, ties to the smaller number, then moves non-empty centroids to the floor of their
    vectors' mean; a last assignment follows.

    Fewer kept vectors than ``clusters`` start that many centroids; none give no rows. Repeated
    rows are vectors of their own. A squared distance beyond 64 bits is null, as is an inertia
    that holds one or does not fit. Columns other than vec_id and embedding are ignored.
    """
    spark = embeddings.sparkSession
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & (F.abs(F.coalesce(x.cast("double"), F.lit(math.nan)) * scale) < math.inf)
    )
    kept = embeddings.filter((F.size("embedding") == dimensions) & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("q")
    )
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    centroids = [[math.floor(x * scale) for x in row["q"]] for row in kept.orderBy(name, "q").limit(clusters).collect()]
    shown = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], shown)
    sizes, sums = [0] * len(centroids), [[0] * dimensions for _ in centroids]
    before, state = None, kept
    for turn in range(rounds + 1):
        centres = Centres(centroids, before)
        table = saved(in_arrow(state, _assign(centres, turn == 0, scale), _STATE))
        state = table.filter("n is null").select("vec_id", "q", "a", "b", "upper", "lower")
        if turn == rounds:
            break
        changes = table.filter("n is not null").select("a", "n", "sums").repartition("a")
        # One row a centroid.
        for row in in_arrow(changes, _summed, "a int, n long, sums array<string>").collect():
            sizes[row["a"]] += row["n"]
            sums[row["a"]] = [x + int(y) for x, y in zip(sums[row["a"]], row["sums"])]
        before, centroids = centroids, [
            [s // n for s in total] if n else old for n, total, old in zip(sizes, sums, centroids)
        ]
    judged = saved(in_arrow(state.select("vec_id", "q", "a"), _distances(centres), "vec_id long, cluster int, distance long"))
    by_cluster = judged.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), (F.count("distance") == F.count("*")).alias("whole")
    )
    inertia = {r["cluster"]: int(r["d"]) if r["whole"] else None for r in by_cluster.collect()}
    fits = lambda d: d if d is not None and d <= LARGEST else None
    total = None if None in inertia.values() else fits(sum(inertia.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = [(c, fits(d), total, digest[c]) for c, d in inertia.items()]
    of = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # At most one row a centroid.
    return judged.join(F.broadcast(of), "cluster").select(*[c.split()[0] for c in shown.split(", ")])


def _sql_round(k: int) -> str:
    return f"""a{k} AS MATERIALIZED (
  SELECT r, any_value(q) AS q, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, v.q, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.q, c{k}.q)])::BIGINT AS d FROM v, c{k}) GROUP BY r),
c{k + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.q, c{k}.q) AS q
  FROM c{k} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q
    FROM (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY c, i) GROUP BY c) AS m USING (c)),
"""


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < {CLUSTERS}),
{"".join(_sql_round(k) for k in range(ROUNDS + 1))}
f AS (SELECT v.vec_id, a.c, a.d FROM a{ROUNDS} AS a JOIN v USING (r))
SELECT vec_id, f.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY f.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c{ROUNDS}.q, ',')) AS centroid_sha256
FROM f JOIN c{ROUNDS} USING (c)
"""
