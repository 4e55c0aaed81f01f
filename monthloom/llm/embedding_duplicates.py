"""Near duplicates of embeddings by NN-descent.

Distinct vectors get neighbour lists from leaves of random-hyperplane trees; rounds of
neighbours-of-neighbours joins refine them. Neighbours at the threshold are links and make
components. A list full of such neighbours is saturated, it may hide links: saturated vectors
search again for neighbours outside their component, until such a search finds no link. Each
search at least halves the number of components that others join, so a list is continued as far
as it takes without getting long. Then all vectors of a component are compared, in blocks that
emit counts and no pairs. A fixed number of query vectors compared with all rows audits the
recall; too low, more trees are added and lists get longer, and if that does not help it is an
error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import components, in_arrow, saved

THRESHOLD = 0.95
#: Neighbours in a list, reverse neighbours that join in, least number of trees, vectors of a leaf, rounds.
NEIGHBOURS, REVERSE, TREES, LEAF, ROUNDS = 10, 10, 8, 96, 3
#: Least chance that a pair at the threshold shares a leaf of some tree.
SHARED = 0.99
#: Further hyperplanes of a tree that divide its crowded leaves.
FURTHER = 24
#: Neighbours that one local join proposes to each of its members.
PROPOSED = 6
#: Vectors of a block of exact comparison.
BLOCK = 256
#: Vectors of the audit, least recall, tries.
QUERIES, LEAST_RECALL, TRIES = 256, 0.98, 3
#: What half precision may take from a cosine.
SLACK = 0.005

LISTS = "cid long, ids array<long>, sims array<float>"


def unit(values: list | None) -> bytes | None:
    """The vector at length one, in double precision; None if it has no direction."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    most = np.abs(x).max()
    if not np.isfinite(most) or most == 0:
        return None
    x = x / most
    return (x / np.sqrt(x @ x) + 0.0).tobytes()


def _units(batches):
    for batch in batches:
        found = [unit(v) for v in batch.column(1).to_pylist()]
        halves = [None if u is None else np.frombuffer(u).astype(np.float16).tobytes() for u in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary()), pa.array(halves, pa.binary())], names=["vec_id", "unit", "half"]
        )


def bits_for(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n / LEAF))))


def trees_for(bits: int) -> int:
    """Trees of ``bits`` hyperplanes that a pair at the threshold needs to share a leaf with a chance of SHARED."""
    same = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return TREES if same == 1 else max(TREES, math.ceil(math.log(1 - SHARED) / math.log(1 - same)))


def _leaves(bits: int, trees: range):
    """For each tree, the side of ``bits`` random hyperplanes a vector is on, and of FURTHER ones."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            halves = batch.column(1).to_pylist()
            keys: list[list[int]] = []
            further: list[list[int]] = []
            for half in halves:
                x = np.frombuffer(half, np.float16).astype(np.float32)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng(len(x) + 7919 * trees.start).standard_normal((len(trees) * (bits + FURTHER), len(x)), np.float32)
                side = (planes[len(x)] @ x > 0).reshape(len(trees), bits + FURTHER)
                keys.append([(len(x) << 40) + int.from_bytes(xxhash.xxh3_64_digest(bytes([t % 251]) + row.tobytes())[:5], "little") if bits else (len(x) << 40) + t for t, row in zip(trees, _codes(side[:, :bits]))])
                further.append((side[:, bits:] @ (1 << np.arange(FURTHER))).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64())), pa.array(further, pa.list_(pa.int64()))], names=["cid", "half", "component", "leaves", "further"])

    return run


def _codes(side: np.ndarray) -> np.ndarray:
    return np.packbits(side, axis=1)


def _best(sims: np.ndarray, ids: np.ndarray, components: np.ndarray, most: int) -> tuple[list, list]:
    """Lists of the ``most`` nearest of other components for each row of a square matrix."""
    sims[components[:, None] == components[None, :]] = -2.0
    k = min(most, len(ids) - 1)
    order = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(ids) - 1 else np.argsort(-sims, axis=1)[:, :k]
    how = np.take_along_axis(sims, order, axis=1)
    return [ids[row[own > -1.5]].tolist() for row, own in zip(order, how)], [own[own > -1.5].tolist() for own in how]


def _local(most: int):
    """All members of a group compared with those of other components; each gets its nearest proposed."""

    def run(batches):
        for batch in batches:
            out, lists, sims = [], [], []
            for members in batch.column(0).to_pylist():
                if len(members) < 2:
                    continue
                ids, of = np.array([m["cid"] for m in members]), np.array([m["component"] for m in members])
                x = np.frombuffer(b"".join(m["half"] for m in members), np.float16).reshape(len(ids), -1).astype(np.float32)
                near, how = _best(x @ x.T, ids, of, most)
                out += ids.tolist()
                lists += near
                sims += how
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32()))], names=["cid", "ids", "sims"]
            )

    return run


def _merge(most: int):
    def run(batches):
        for batch in batches:
            ids, sims = [], []
            for lists in batch.column(1).to_pylist():
                best: dict[int, float] = {}
                for one in lists:
                    best.update(zip(one["ids"], one["sims"]))
                top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:most]
                ids.append([a for a, _ in top])
                sims.append([b for _, b in top])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32()))], names=["cid", "ids", "sims"])

    return run


def merged(lists: DataFrame, most: int) -> DataFrame:
    gathered = lists.groupBy("cid").agg(F.collect_list(F.struct("ids", "sims")).alias("lists"))
    return saved(in_arrow(gathered, _merge(most), LISTS))


def initial_lists(classes: DataFrame, n: int, most: int, trees: range) -> DataFrame:
    """Nearest vectors in the leaves of several trees.

    A crowded leaf is divided by further hyperplanes, what is still crowded then into chunks by a hash.
    """
    kind = "cid long, half binary, component long, leaves array<long>, further array<long>"
    coded = in_arrow(classes.select("cid", "half", "component"), _leaves(bits_for(n), trees), kind)
    placed = coded.select("cid", "half", "component", F.posexplode(F.arrays_zip("leaves", "further")).alias("tree", "leaf")).select(
        "cid", "half", "component", "tree", "leaf.leaves", "leaf.further"
    )
    crowds = placed.groupBy("tree", "leaves").agg(F.count("*").alias("n"))
    depth = F.least(F.lit(FURTHER), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / LEAF)))).cast("long")
    part = F.pmod("further", F.pow(F.lit(2.0), depth).cast("long"))
    placed = placed.join(crowds, ["tree", "leaves"]).withColumn("part", part).drop("n", "further")
    sizes = placed.groupBy("tree", "leaves", "part").agg(F.count("*").alias("n"))
    chunk = F.pmod(F.xxhash64("cid", "tree"), F.ceil(F.col("n") / LEAF))
    groups = placed.join(sizes, ["tree", "leaves", "part"]).groupBy("tree", "leaves", "part", chunk.alias("chunk")).agg(F.collect_list(F.struct("cid", "half", "component")).alias("members"))
    return merged(in_arrow(groups.select("members"), _local(most), LISTS), most)


def refine(lists: DataFrame, classes: DataFrame, most: int, inner: DataFrame | None = None) -> DataFrame:
    """One round: a vector's neighbours and reverse neighbours are compared with each other.

    With ``inner``, the neighbours in its lists join in: those inside a component, where
    ``lists`` hold those outside.
    """
    edges = lists.select("cid", F.explode("ids").alias("other"))
    if inner is not None:
        edges = edges.union(inner.select("cid", F.explode("ids"))).distinct()
    order = Window.partitionBy("other").orderBy(F.xxhash64("cid", "other"))
    reverse = edges.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= REVERSE)
    members = (
        edges.select(F.col("cid").alias("owner"), F.col("other").alias("cid"))
        .union(reverse.select("other", "cid"))
        .union(lists.select("cid", "cid"))
        .distinct()
    )
    groups = members.join(classes.select("cid", "half", "component"), "cid").groupBy("owner").agg(F.collect_list(F.struct("cid", "half", "component")).alias("members"))
    return merged(in_arrow(groups.select("members"), _local(PROPOSED), LISTS).union(lists), most)


def neighbours(classes: DataFrame, n: int, most: int, trees: range, inner: DataFrame | None = None) -> DataFrame:
    """Lists of the nearest vectors of other components, refined until they hardly change."""
    lists = initial_lists(classes, n, most, trees)
    total = None
    for _ in range(ROUNDS):
        lists = refine(lists, classes, most, inner)
        now = lists.agg(F.sum(F.aggregate("sims", F.lit(0.0), lambda a, s: a + s))).first()[0] or 0.0
        if total is not None and now - total <= 0.002 * abs(now):
            break
        total = now
    return lists


def _exact(batches):
    for batch in batches:
        a, b = ([np.frombuffer(u) for u in batch.column(k).to_pylist()] for k in (2, 3))
        keep = [float(x @ y) >= THRESHOLD for x, y in zip(a, b)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def exact_links(lists: DataFrame, classes: DataFrame) -> DataFrame:
    near = lists.select("cid", F.explode(F.arrays_zip("ids", "sims")).alias("n")).filter(F.col("n.sims") >= THRESHOLD - SLACK)
    pairs = near.select(F.least("cid", F.col("n.ids")).alias("a"), F.greatest("cid", F.col("n.ids")).alias("b")).distinct()
    units = classes.select("cid", "unit")
    both = (
        pairs.join(units.select(F.col("cid").alias("a"), F.col("unit").alias("ua")), "a")
        .join(units.select(F.col("cid").alias("b"), F.col("unit").alias("ub")), "b")
        .select("a", "b", "ua", "ub")
    )
    return in_arrow(both, _exact, "a long, b long")


def joined_components(lists: DataFrame, classes: DataFrame, most: int, trees: range) -> DataFrame:
    """(id, component) by the links of ``lists``, and of what saturated lists do not hold, as a saved table."""
    joined = saved(components(saved(exact_links(lists, classes))))
    full = saved(lists.filter((F.size("ids") >= most) & (F.array_min("sims") >= THRESHOLD - SLACK)).select("cid"))
    while True:
        searching = saved(
            classes.select("cid", "half").join(full, "cid", "left_semi").join(joined.withColumnRenamed("id", "cid"), "cid", "left")
            .select("cid", "half", F.coalesce("component", "cid").alias("component"))
        )
        n, low, high = searching.agg(F.count("*"), F.min("component"), F.max("component")).first()
        if low == high:  # of one component, or none
            return joined
        new = saved(exact_links(neighbours(searching, n, most, trees, lists), classes))
        if new.isEmpty():
            return joined
        joined = saved(components(joined.select(F.col("id").alias("a"), F.col("component").alias("b")).union(new)))


def _degrees(batches):
    for batch in batches:
        ids, links = [], []
        for members in batch.column(0).to_pylist():
            x = np.frombuffer(b"".join(m["unit"] for m in members)).reshape(len(members), -1)
            own, weight = np.array([m["cid"] for m in members]), np.array([m["copies"] for m in members])
            side = np.array([m["side"] for m in members])
            if side.min() == side.max():
                near = x @ x.T >= THRESHOLD
                np.fill_diagonal(near, False)
                total = near @ weight
            else:
                near = x[side == 0] @ x[side == 1].T >= THRESHOLD
                total = np.empty(len(own), np.int64)
                total[side == 0], total[side == 1] = near @ weight[side == 1], near.T @ weight[side == 0]
            ids += own.tolist()
            links += total.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64())], names=["cid", "links"])


def degrees(joined: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, links): rows linked with each vector, over the whole of its component.

    Blocks of about BLOCK vectors meet two by two; a meeting gives a count for each vector.
    """
    sizes = joined.groupBy("component").agg(F.count("*").alias("n"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    dealt = (
        joined.withColumnRenamed("id", "cid").join(sizes, "component").join(classes.select("cid", "copies", "unit"), "cid")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("side", F.when(F.col("own") <= F.col("other"), 0).otherwise(1))
    )
    meetings = dealt.groupBy("component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).agg(
        F.collect_list(F.struct("cid", "copies", "unit", "side")).alias("members")
    )
    counted = in_arrow(meetings.select("members"), _degrees, "cid long, links long")
    return counted.groupBy("cid").agg(F.sum("links").alias("links"))


def audit(classes: DataFrame, found: DataFrame) -> float:
    """Mean share of a vector's links that are in ``found``, over those of QUERIES vectors that have links.

    The vectors are compared with all rows.
    """
    chosen = classes.orderBy(F.xxhash64("unit"), "cid").select("cid", "unit").limit(QUERIES)
    rows = [(r["cid"], bytes(r["unit"])) for r in chosen.collect()]
    if not rows:
        return 1.0
    shared = classes.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        by_size: dict[int, tuple[list, np.ndarray]] = {}
        for size in {len(u) for _, u in shared.value}:
            group = [(c, u) for c, u in shared.value if len(u) == size]
            by_size[size] = [c for c, _ in group], np.frombuffer(b"".join(u for _, u in group)).reshape(len(group), -1)
        for batch in batches:
            total: dict[int, int] = {}
            for cid, copies, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                names, matrix = by_size.get(len(raw), ([], None))
                if names:
                    for k in np.flatnonzero(matrix @ np.frombuffer(raw) >= THRESHOLD).tolist():
                        if names[k] != cid:
                            total[names[k]] = total.get(names[k], 0) + copies
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int64()), pa.array(total.values(), pa.int64())], names=["cid", "links"])

    truth = in_arrow(classes.select("cid", "copies", "unit"), run, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("true"))
    share = truth.join(found, "cid", "left").agg(F.avg(F.coalesce("links", F.lit(0)) / F.col("true"))).first()[0]
    return 1.0 if share is None else float(share)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Vectors of one length with a cosine of at least 0.95 are linked. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest vec_id reachable.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    vectors of different lengths do not link. Equal directions are compared once and counted
    with their copies; repeated rows are copies. A row with null vec_id links like others but
    names no component; it is kept. An empty table gives no rows; other columns are ignored.
    A recall that stays under LEAST_RECALL in the audit is an error.
    """
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    rows = saved(in_arrow(embeddings.select("vec_id", "embedding"), _units, f"vec_id {kind}, unit binary, half binary"))
    classes = saved(
        rows.filter("unit is not null").groupBy("unit", "half").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    n, most, first, before = classes.count(), NEIGHBOURS, 0, None
    trees = trees_for(bits_for(n))
    for _ in range(TRIES):
        own = range(first, first + trees)
        lists = neighbours(classes.withColumn("component", F.col("cid")), n, most, own)
        if before is not None:
            lists = merged(lists.union(before), most)
        joined = joined_components(lists, classes, most, own)
        found = saved(degrees(joined, classes))
        recall = audit(classes, found)
        if recall >= LEAST_RECALL:
            break
        most, first, trees, before = most * 2, first + trees, trees * 2, lists
    else:
        raise RuntimeError(f"recall {recall:.4f} of {QUERIES} vectors is under {LEAST_RECALL} after {TRIES} tries")
    own = classes.join(joined.withColumnRenamed("id", "cid"), "cid", "left").join(found, "cid", "left")
    smallest = own.filter("component is not null").groupBy("component").agg(F.min("low").alias("least"))
    own = own.join(smallest, "component", "left").select(
        F.col("unit").alias("u"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("least", "low").alias("least")
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id"))
    return rows.select("vec_id", "unit").join(own, F.col("unit") == F.col("u"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(e, e) > 0),
l AS MATERIALIZED (SELECT a.k AS a, b.k AS b, a.vec_id AS va, b.vec_id AS vb FROM ok AS a JOIN ok AS b ON a.k <> b.k AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT a AS k, least(va, vb) AS c FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.k),
c AS (SELECT k, min(c) AS c FROM r GROUP BY k), n AS (SELECT a AS k, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM v LEFT JOIN c USING (k) LEFT JOIN n USING (k)
"""
