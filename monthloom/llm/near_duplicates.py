"""Near duplicates of word shingles by a chosen-path set similarity join.

Every tree starts with all distinct sets in its root. A node picks some of the minwise tokens
(by a hash of the node) and sends each set to the children its own tokens name, so sets
that are alike stay together and the rest parts.

* In each root child, every set is paired with the smallest id in it: a number of pairs
  linear in the rows. Pairs with alike sketches are confirmed on full sets; that alone joins
  most of a group of copies of any size.
* Sets that resemble the same smallest id are a family. In it, whoever is not yet joined to
  the largest part is compared with everyone on full sets, block by block, if these are few.
  If they are many, blocks of the family meet two by two, each pair once whatever nodes it
  shares; only in a family of over FAMILY sets each counts as a family of its own in what follows.
* What other nodes still hold apart is compared exhaustively where nodes are small, branches
  again where they are not, and is compared block by block at the last depth. A block names
  its sets with alike sketches, compares them on full sets and gives the links that join
  its parts: fewer than it has sets, however many of them are alike.

Trees are independent: a pair at the threshold misses all root children with a chance of
0.25 ** (TREES * FANOUT). Its sketch is the same in all trees: it agrees in less than
LEAST_AGREEMENT, so that no tree confirms the pair, with a chance of 0.00007.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import components, in_arrow, saved

WORDS = 5
#: Least similarity of linked sets, in hundredths.
PERCENT = 75
TREES, FANOUT, DEPTH = 12, 2, 5
#: Minwise tokens of a sketch, a byte each.
TOKENS = 128
#: Sketches that agree in a smaller share are not confirmed: 3.9 standard deviations below PERCENT.
LEAST_AGREEMENT = 0.60
#: Sets whose sketch agrees that much with that of the smallest id are of its family.
RESEMBLES = 0.35
#: Sets outside the largest family of a node, or the largest part of a family, that is compared exhaustively.
SMALL = 64
#: Sets of a family or a node's largest family that are compared in one place.
BLOCK = 256
#: Sets of a family with many outside its largest part that is compared once, block by block, and branches no more.
FAMILY = 4096

_RANDOM = np.random.default_rng(20240501)
MULTIPLIERS = _RANDOM.integers(1, 1 << 63, TOKENS + TREES * FANOUT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1, 1 << 63, WORDS + 2, dtype=np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEP[-1]
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; of fewer words, of all of them."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(WORDS, len(words))
    with np.errstate(over="ignore"):
        value = np.full(len(words) - size + 1, size, np.uint64) * STEP[-2]
        for k in range(size):
            value = (value ^ (value >> np.uint64(32))) * STEP[k] + hashes[k : len(words) - size + 1 + k]
        return np.unique(mixed(value))


def minima(found: np.ndarray) -> np.ndarray:
    """The minwise token of a set under each multiplier."""
    low = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 1024):
            np.minimum(low, np.multiply.outer(found[at : at + 1024], MULTIPLIERS).min(axis=0), out=low)
        return mixed(low)


def _signatures(batches):
    for batch in batches:
        sizes, first, second, sketches, roots = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            name = xxhash.xxh3_128_digest(found.tobytes())
            first.append(int.from_bytes(name[:8], "little", signed=True))
            second.append(int.from_bytes(name[8:], "little", signed=True))
            low = minima(found) >> np.uint64(32)
            sketches.append((low[:TOKENS] & np.uint64(255)).astype(np.uint8).tobytes())
            roots.append(low[TOKENS:].astype(np.int64).tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array(sketches, pa.binary()), pa.array(roots, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set1", "set2", "sketch", "roots"],
        )


def _agreement(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, TOKENS) for k in (2, 3))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array((a == b).mean(axis=1), pa.float64())], names=["a", "b", "agreement"]
        )


def _confirm(batches):
    """Pairs of texts whose full sets are similar; the first of neighbouring pairs often is the same."""
    last, own = None, None
    for batch in batches:
        keep = []
        for name, left, right in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if name != last:
                last, own = name, shingles(left)
            other = shingles(right)
            common = len(np.intersect1d(own, other, assume_unique=True))
            keep.append(common > 0 and 100 * common >= PERCENT * (len(own) + len(other) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def resembling(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, agreement) of the pairs whose sketches agree enough, as a saved table."""
    sketch = classes.select("cid", "sketch")
    both = (
        pairs.join(sketch.select(F.col("cid").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(sketch.select(F.col("cid").alias("b"), F.col("sketch").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )
    return saved(in_arrow(both, _agreement, "a long, b long, agreement double").filter(F.col("agreement") >= least))


def texts_of(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """(cid, text) of every set named in ``ids`` (cid), as a saved table; several of a doc_id if it has them."""
    texts = documents.select(F.col("doc_id").cast("long").alias("cid"), F.col("text").cast("binary").alias("text"))
    return saved(texts.join(saved(ids.distinct()), "cid", "left_semi").dropDuplicates(["cid", "text"]))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar, as a saved table."""
    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
        .join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
    )
    return saved(in_arrow(both, _confirm, "a long, b long"))


def _across(batches):
    """Links on full sets that join parts of a block; of several that join the same, the first.

    Sets outside the largest part are compared with all others of the block, until it is one
    part: of n sets, at most n - 1 links.
    """
    for batch in batches:
        left, right = [], []
        for members in batch.column(0).to_pylist():
            ids, root = [m["cid"] for m in members], {}

            def find(x, root=root):
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            sets = [shingles(m["text"]) for m in members]
            sizes = np.array([len(x) for x in sets])
            owner, ends = np.repeat(np.arange(len(sets)), sizes), np.cumsum(sizes)
            tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
            mark = np.zeros(len(tokens), bool)
            left_over = len({m["part"] for m in members}) - 1
            for k, m in enumerate(members):
                if not left_over:
                    break
                if not m["outside"]:
                    continue
                own = place[ends[k] - sizes[k] : ends[k]]
                mark[own] = True
                common = np.bincount(owner[mark[place]], minlength=len(sets))
                mark[own] = False
                for j in np.flatnonzero((common > 0) & (100 * common >= PERCENT * (sizes + sizes[k] - common))).tolist():
                    x, y = find(m["part"]), find(members[j]["part"])
                    if x != y:
                        root[x] = y
                        left_over -= 1
                        left.append(min(ids[k], ids[j]))
                        right.append(max(ids[k], ids[j]))
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def apart_families(families: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, cid, part, outside, n, n_outside, blocks): members of families of several parts, as a saved table.

    ``outside`` are those that are not in the largest part.
    """
    members = (
        families.select("a", F.col("b").alias("cid")).union(families.select("a", "a")).distinct()
        .join(parts, "cid", "left").select("a", "cid", F.coalesce("component", "cid").alias("part"))
    )
    counted = members.groupBy("a", "part").agg(F.count("*").alias("n"))
    shape = counted.groupBy("a").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("largest"))
    apart = shape.filter("largest.n < n").select(
        "a", "n", F.col("largest.part").alias("main"), (F.col("n") - F.col("largest.n")).alias("n_outside"), F.ceil(F.col("n") / BLOCK).alias("blocks")
    )
    return saved(
        members.join(apart, "a").select("a", "cid", "part", (F.col("part") != F.col("main")).alias("outside"), "n", "n_outside", "blocks")
    )


def family_links(apart: DataFrame, texts: DataFrame) -> DataFrame:
    """Links across the parts of each family with few sets outside its largest part, as a saved table.

    Sets of the largest part stay in one block each; the others, at most SMALL, visit every block.
    """
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    placed = apart.filter(F.col("n_outside") <= SMALL).withColumn(
        "block", F.explode(F.when(F.col("outside"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own)))
    )
    gathered = placed.join(texts, "cid").groupBy("a", "block").agg(F.collect_list(F.struct("cid", "part", "outside", "text")).alias("members"))
    return saved(in_arrow(gathered.select("members"), _across, "a long, b long"))


def _children(depth):
    def run(batches):
        for batch in batches:
            nodes, ids, parts, families, sketches = (batch.column(k).to_pylist() for k in range(5))
            value = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, TOKENS)
            node = np.array(nodes, np.int64).view(np.uint64)
            out = []
            with np.errstate(over="ignore"):
                for branch in range(2):
                    chosen = mixed(node * STEP[branch] + np.uint64(depth))
                    # The second token is picked by every third node: 4/3 children, one over the threshold.
                    rows = np.flatnonzero(chosen % np.uint64(3) == 0) if branch else np.arange(len(node))
                    token = (chosen >> np.uint64(40)) % np.uint64(TOKENS)
                    byte = value[rows, token[rows].astype(np.int64)]
                    child = mixed(chosen[rows] + STEP[2] * (byte.astype(np.uint64) + np.uint64(1))).view(np.int64)
                    out.append((child, rows))
            rows = np.concatenate([r for _, r in out]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([c for c, _ in out])), *(pa.array([x[r] for r in rows], pa.int64()) for x in (ids, parts, families)),
                 pa.array([sketches[r] for r in rows], pa.binary())],
                names=["node", "cid", "part", "family", "sketch"],
            )

    return run


def _alike(batches):
    """The members of each block that have an alike sketch of another part and family in it; of two sides, across them."""
    for batch in batches:
        keys, out = [batch.column(k).to_pylist() for k in range(3)], ([], [], [], [], [])
        for *key, members in zip(*keys, batch.column(3).to_pylist()):
            value = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint8).reshape(-1, TOKENS)
            part, family, side = (np.array([m[c] for m in members]) for c in ("part", "family", "side"))
            across = side.min() != side.max()
            found = np.zeros(len(members), bool)
            for k in range(len(members)):
                ok = (part[k + 1 :] != part[k]) & (family[k + 1 :] != family[k]) & ((side[k + 1 :] != side[k]) if across else True)
                rest = np.flatnonzero(ok) + k + 1
                rest = rest[(value[rest] == value[k]).mean(axis=1) >= LEAST_AGREEMENT] if len(rest) else rest
                found[rest] = True
                found[k] |= len(rest) > 0
            for k in np.flatnonzero(found).tolist():
                for column, one in zip(out, (*key, members[k]["cid"], members[k]["part"])):
                    column.append(one)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["node", "x", "y", "cid", "part"])


def _alike_within(rows: DataFrame) -> DataFrame:
    """(node, x, y, cid, part): what is to be compared on full sets in each block of bounded size."""
    gathered = rows.groupBy("node", "x", "y").agg(F.collect_list(F.struct("cid", "part", "family", "sketch", "side")).alias("members"))
    return in_arrow(gathered, _alike, "node long, x long, y long, cid long, part long")


def block_links(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join the parts of each block (node, x, y, cid, part), confirmed on full sets, as a saved table."""
    gathered = (
        blocks.join(texts, "cid")
        .groupBy("node", "x", "y")
        .agg(F.collect_list(F.struct("cid", "part", F.lit(True).alias("outside"), "text")).alias("members"))
    )
    return saved(in_arrow(gathered.select("members"), _across, "a long, b long"))


def family_blocks(families: DataFrame, classes: DataFrame) -> DataFrame:
    """Blocks (node, x, y, cid, part) to compare, of families with many sets outside their largest part.

    Blocks of BLOCK / 2 sets meet two by two, but for those of the largest part among themselves.
    """
    half, zero = BLOCK // 2, F.lit(0).cast("long")
    first = F.ceil(F.col("n_outside") / half)
    every = first + F.ceil((F.col("n") - F.col("n_outside")) / half)
    own = F.when(F.col("outside"), F.pmod(F.xxhash64("cid"), first)).otherwise(first + F.pmod(F.xxhash64("cid"), every - first))
    dealt = (
        families.join(classes.select("cid", "sketch"), "cid")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(zero, F.when(F.col("outside"), every).otherwise(first) - 1)))
        .select(
            F.xxhash64(F.lit("family"), "a").alias("node"), F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
            "cid", "part", F.col("cid").alias("family"), "sketch", F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        )
    )
    return saved(_alike_within(dealt))


#: Holds for nodes with several parts and several families, of ``_spread``.
APART = "p0 < p1 and f0 < f1"


def _spread():
    return [f(c).alias(f"{c[0]}{k}") for c in ("part", "family") for k, f in enumerate((F.min, F.max))]


def _branching(nodes: DataFrame) -> DataFrame:
    """Blocks (node, x, y, cid, part) to compare, of nodes (node, cid, part, family, sketch) that hold sets apart."""
    found = None
    for depth in range(DEPTH + 1):
        nodes = saved(nodes)  # read twice
        by_family = nodes.groupBy("node", "family").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
        sizes = (
            by_family.groupBy("node")
            .agg(
                F.sum("n").alias("n"), F.max(F.struct("n", "family")).alias("largest"), F.min("low").alias("p0"),
                F.max("high").alias("p1"), F.min("family").alias("f0"), F.max("family").alias("f1"),
            )
            .filter(f"n > 1 and {APART}")
            .select("node", "n", (F.col("n") - F.col("largest.n")).alias("outside"), F.col("largest.family").alias("main"))
        )
        nodes = saved(nodes.join(sizes, "node").withColumn("side", F.lit(0)))
        # Few sets outside the largest family meet all others, in blocks of the rest.
        blocks = F.ceil(F.col("n") / BLOCK)
        own = F.array(F.pmod(F.xxhash64("cid"), blocks))
        every = F.sequence(F.lit(0).cast("long"), blocks - 1)
        small = nodes.filter(F.col("outside") <= SMALL).withColumn(
            "x", F.explode(F.when(F.col("family") == F.col("main"), own).otherwise(every))
        )
        alike = _alike_within(small.withColumn("y", F.lit(-1).cast("long")))
        large = nodes.filter(F.col("outside") > SMALL)
        last = depth == DEPTH or large.isEmpty()
        if last:
            # Blocks of BLOCK / 2 sets meet two by two.
            block = F.pmod(F.xxhash64("cid"), F.col("blocks"))
            dealt = (
                large.withColumn("blocks", F.ceil(F.col("n") * 2 / BLOCK))
                .withColumn("own", block)
                .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                .withColumn("x", F.least("own", "other"))
                .withColumn("y", F.greatest("own", "other"))
                .withColumn("side", F.when(F.col("own") == F.col("x"), 0).otherwise(1))
            )
            alike = alike.union(_alike_within(dealt))
        # Nodes of two depths have names of their own: the depth is hashed into a child's.
        alike = saved(alike)
        found = alike if found is None else found.union(alike)
        if last:
            return found
        nodes = in_arrow(large.select("node", "cid", "part", "family", "sketch"), _children(depth), "node long, cid long, part long, family long, sketch binary")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    Texts are words between ASCII white space, A-Z in lower case; sets hold the distinct
    5-word shingles, or all words as one where there are fewer. Sets with
    ``100 * intersection >= 75 * union`` are linked; ``component_id`` is the smallest doc_id
    reachable, ``kept`` says that it is the document's own.

    Null and blank texts have an empty set and link with nothing. Rows of one doc_id are one
    document: they share a component. A row with null doc_id has no component of its own:
    component_id is null, and it is kept. An empty table gives no rows. doc_id is an integer;
    other columns are ignored.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    signed = saved(
        in_arrow(source, _signatures, "doc_id long, n_shingles long, set1 long, set2 long, sketch binary, roots array<long>")
    )
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    names = filled.groupBy("set1", "set2").agg(F.min("doc_id").alias("cid"), F.count("*").alias("copies"))
    # One row of each distinct set: that of its smallest id.
    classes = saved(
        filled.join(names.withColumnRenamed("cid", "doc_id").drop("copies"), ["set1", "set2", "doc_id"], "left_semi")
        .dropDuplicates(["set1", "set2"])
        .select(F.col("doc_id").alias("cid"), "set1", "set2", "sketch", "roots")
    )
    placed = classes.select("cid", F.posexplode("roots").alias("token", "value")).select(
        F.xxhash64("token", "value").alias("node"), "cid"
    )
    nodes = placed.groupBy("node").agg(F.count("*").alias("n"), F.min("cid").alias("pivot")).filter("n > 1")
    members = saved(placed.join(nodes, "node"))
    stars = members.filter("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    stars = resembling(stars, classes, RESEMBLES)
    families = stars.groupBy("b").agg(F.min("a").alias("a"))
    texts = texts_of(stars.select(F.col("a").alias("cid")).union(stars.select("b")), source)
    links = confirmed(stars.filter(F.col("agreement") >= LEAST_AGREEMENT), texts)
    parts = saved(components(links)).select(F.col("id").alias("cid"), "component")
    divided = apart_families(families, parts)
    links = links.union(family_links(divided, texts))
    many = divided.filter(F.col("n_outside") > SMALL)
    within = family_blocks(many.filter(F.col("n") <= FAMILY), classes)
    # Those outside the largest part of a larger family are compared with it by branching, as if of no family.
    single = many.filter(F.col("outside") & (F.col("n") > FAMILY)).select("a", F.col("cid").alias("b"))
    families = families.join(single, ["a", "b"], "left_anti")
    open_ = (
        members.filter("n > 2").select("node", "cid").join(parts, "cid", "left")
        .join(families.select(F.col("b").alias("cid"), F.col("a").alias("family")), "cid", "left")
        .select("node", "cid", F.coalesce("component", "cid").alias("part"), F.coalesce("family", "cid").alias("family"))
    )
    apart = open_.groupBy("node").agg(*_spread()).filter(APART).select("node")
    rows = open_.join(apart, "node", "left_semi").join(classes.select("cid", "sketch"), "cid")
    blocks = within.union(_branching(rows.select("node", "cid", "part", "family", "sketch")))
    more = block_links(blocks, texts_of(blocks.select("cid"), source))
    final = components(links.union(more).union(signed_ids(filled, names)))
    of = names.join(final.select(F.col("id").alias("cid"), "component"), "cid", "left").select(
        "set1", "set2", F.coalesce("component", "cid").alias("component_id")
    )
    return signed.select("doc_id", "n_shingles", "set1", "set2").join(
        of.select(F.col("set1").alias("s1"), F.col("set2").alias("s2"), "component_id"),
        (F.col("set1") == F.col("s1")) & (F.col("set2") == F.col("s2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left",
    ).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def signed_ids(filled: DataFrame, names: DataFrame) -> DataFrame:
    """(a, b) between the sets of a doc_id that has several texts."""
    own = filled.select("doc_id", "set1", "set2").distinct()
    several = own.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    return own.join(several, "doc_id").join(names, ["set1", "set2"]).filter("doc_id <> cid").select(F.col("doc_id").alias("a"), F.col("cid").alias("b"))


_WORDS = r"[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> '']"
SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), {WORDS}) - 1], ' ') || chr(31) || least(len(w), {WORDS}) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS}, 0) + 2)) AS k FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, least(a, b) AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
