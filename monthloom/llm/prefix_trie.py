"""Conversation prefix trie by collapse of whole sequences.

Conversations are rebuilt from shared heads; identical ones collapse to one weighted sequence
with the list of its ends. Sequences that are proper prefixes of others drop out of the leaves
by an anti-join, and every node is an aggregate over the weighted sequences that pass it: no
tree is walked, and no level waits for another.

* A prefix is named by its length and two 64-bit lanes. A lane is the exclusive or of a hash of
  each turn with its position, so a running aggregate gives it; runs are cut into blocks of
  positions, so that a conversation of any length is spread over tasks.
* Sums over a subtree are sums over sequences. Bytes of members: what a sequence holds from
  here on, times its weight. Bytes of distinct nodes: each node counts for the sequence of its
  smallest member, which owns its path from some depth on to its end.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import in_arrow, saved

#: Conversations of one head; turns of a head are the remainder of a checksum by HEADS.
SHARE, HEADS = 5, 9
#: Positions of a conversation that one task runs over at once.
BLOCK = 1024
#: Ids of one list of ends that are joined to one text before they are hashed.
IDS = 4096
KEY = ("depth", "k1", "k2")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, c1, c2, bytes) of every turn, as a saved table.

    Turns are sorted globally and counted by partition, so a conversation that holds most rows
    is not sorted in one task.
    """
    order = ("conv_id", "turn", "role", "text")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    placed = saved(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id", F.xxhash64(F.lit(1), "role", "text").alias("c1"), F.xxhash64(F.lit(2), "text", "role").alias("c2"),
            F.octet_length("text").cast("long").alias("bytes"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        )
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return saved(
        placed.join(runs.drop("n"), ["conv_id", "part"]).select(
            "conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("position"), "c1", "c2", "bytes"
        )
    )


def head_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, position, length, c1, c2, bytes) and shapes (conv_id, length).

    Conversation c is the first h turns of c - c % SHARE, all if there are fewer and none if
    that is absent, then its own turns after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    of = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % SHARE).alias("base"), head_turns(F.col("conv_id")).alias("h"))
    shapes = saved(
        of.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
        .withColumn("start", F.least("h", F.coalesce("n_base", F.lit(0))))
        .select("conv_id", "base", "h", "start", (F.col("start") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    )
    # At most 2 * SHARE - 1 conversations have one head: those around zero.
    heads = turns.filter((F.col("position") < HEADS) & (F.col("conv_id") % SHARE == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(shapes.select("base", "conv_id", "h", "length"), "base").filter("position <= h")
    own = turns.join(shapes, "conv_id").filter("position > h").withColumn("position", F.col("position") - F.col("h") + F.col("start"))
    columns = ("conv_id", "position", "length", "c1", "c2", "bytes")
    return heads.select(*columns).unionByName(own.select(*columns)), shapes.select("conv_id", "length")


def prefixes(rows: DataFrame) -> DataFrame:
    """Turns with the key of their prefix, that of the one before, and the bytes up to here."""
    lanes = [F.xxhash64(F.lit(k), "position", "c1", "c2").alias(f"lane{k}") for k in (1, 2)]
    blocks = rows.select("conv_id", "position", "length", "bytes", *lanes, F.floor((F.col("position") - 1) / BLOCK).alias("block"))
    blocks = saved(blocks)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = blocks.groupBy("conv_id", "block").agg(
        F.bit_xor("lane1").alias("b1"), F.bit_xor("lane2").alias("b2"), F.sum("bytes").alias("b3")
    )
    sums = sums.select("conv_id", "block", *[F.coalesce(f(b).over(before), F.lit(0)).alias(b) for f, b in ((F.bit_xor, "b1"), (F.bit_xor, "b2"), (F.sum, "b3"))])
    running = blocks.withColumns(
        {"x1": F.bit_xor("lane1").over(inside), "x2": F.bit_xor("lane2").over(inside), "x3": F.sum("bytes").over(inside)}
    )
    joined = running.join(sums, ["conv_id", "block"])
    keys = {f"k{k}": F.col(f"x{k}").bitwiseXOR(F.col(f"b{k}")) for k in (1, 2)}
    return joined.withColumns(keys).select(
        "conv_id", F.col("position").alias("depth"), "k1", "k2", *[F.col(f"k{k}").bitwiseXOR(F.col(f"lane{k}")).alias(f"p{k}") for k in (1, 2)],
        "length", "bytes", (F.col("x3") + F.col("b3")).alias("upto"),
    )


def _listed(batches):
    """Texts of at most IDS sorted ids of one sequence each."""

    def text():
        return {"depth": key[0], "k1": key[1], "k2": key[2], "first": ids[0], "listed": ",".join(map(str, ids))}

    key, ids = None, []
    kind = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("listed", pa.string())])
    for batch in batches:
        done = []
        for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if row[:3] != key or len(ids) >= IDS:
                if ids:
                    done.append(text())
                key, ids = row[:3], []
            ids.append(row[3])
        yield pa.RecordBatch.from_pylist(done, kind)
    if ids:
        yield pa.RecordBatch.from_pylist([text()], kind)


def _hashed(batches):
    """One digest for each key from its texts, which follow each other in order."""
    key, state = None, None
    kind = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for row in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
            if row[:3] != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = row[:3], hashlib.sha256(row[3].encode())
            else:
                state.update(b"," + row[3].encode())
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in done], kind)
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (*key, state.hexdigest())))], kind)


def end_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each sequence.

    Ids are sorted over all tasks and joined to texts there. One task then reads the texts of a
    sequence and holds a hash state, never the list: SHA-256 has to read them in order.
    """
    order = (*KEY, "conv_id")
    texts = in_arrow(
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order), _listed, "depth long, k1 long, k2 long, first long, listed string"
    )
    dealt = texts.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return in_arrow(dealt, _hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences.

    ``rows``: (conv_id, position, length, c1, c2, bytes), positions from 1 to length without a
    gap; ``shapes``: (conv_id, length), empty sequences included.
    """
    paths = saved(prefixes(rows))
    zero = F.lit(0).cast("long")
    root = {name: zero for name in KEY}
    whole = paths.filter("depth = length").select("conv_id", *KEY, F.col("upto").alias("total"))
    ends = saved(whole.unionByName(shapes.filter("length = 0").select("conv_id", *[c.alias(n) for n, c in root.items()], zero.alias("total"))))
    sequences = saved(ends.groupBy(*KEY).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.max("total").alias("total")))
    passing = paths.withColumnRenamed("conv_id", "rep").join(sequences.select("rep", "weight", "total"), "rep")
    proper = passing.filter("depth < length").select(*KEY).unionByName(sequences.filter("depth > 0").select(*[c.alias(n) for n, c in root.items()]))
    leaves = sequences.join(proper.distinct(), list(KEY), "left_anti").select("rep", F.lit(1).cast("long").alias("leaf"))
    weighted = saved(
        sequences.select("rep", *[c.alias(n) for n, c in root.items()], zero.alias("p1"), zero.alias("p2"), zero.alias("bytes"), zero.alias("upto"), "weight", "total")
        .unionByName(passing.drop("length"))
        .join(leaves, "rep", "left")
        .withColumn("leaf", F.coalesce("leaf", zero))
    )
    rest = F.col("total") - F.col("upto") + F.col("bytes")
    nodes = saved(
        weighted.groupBy(*KEY).agg(
            F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
            F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * rest).alias("member_bytes"),
        )
    )
    # From which byte on a sequence owns its path.
    owned = (
        weighted.join(nodes.select(*KEY, F.col("conv_id").alias("rep")), [*KEY, "rep"])
        .groupBy("rep").agg(F.min(F.col("upto") - F.col("bytes")).alias("from"))
    )
    distinct_bytes = (
        weighted.join(owned, "rep").groupBy(*KEY)
        .agg(F.sum(F.col("total") - F.greatest(F.col("upto") - F.col("bytes"), F.col("from"))).alias("node_bytes"))
    )
    parent = ((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    inner = nodes.filter("depth > 0")
    children = inner.select(*parent).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(distinct_bytes, list(KEY))
        .join(children, list(KEY), "left")
        .join(end_lists(ends), list(KEY), "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
            (F.col("member_bytes") - F.col("node_bytes")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the prefix trie of all rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (sum over the subtree of members but one times bytes of the node's
    text), ends_sha256 (digest of the ids that end here).

    Turns are ordered by turn, null first, ties by role and text; null role or text is empty.
    Rows of null conv_id belong to no conversation and are left out. Repeated rows are turns of
    their own. Texts and conversations may be of any length. An empty table gives no rows, not
    even a root. Columns other than conv_id, turn, role, text are ignored.
    """
    return prefix_trie(*rebuilt(numbered(conversations)))


_CRC = (
    "xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]), lambda crc, byte: "
    "list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)
SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS position,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
s AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % {SHARE} AS base, {_CRC} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, position) AS depth, role, text
  FROM (SELECT s.conv_id, 0 AS part, position, role, text FROM s JOIN t ON t.conv_id = s.base AND position <= h
        UNION ALL SELECT conv_id, 1, position, role, text FROM t JOIN s USING (conv_id) WHERE position > h)),
p AS MATERIALIZED (
  SELECT conv_id, depth, strlen(text) AS bytes,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY depth)
           OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM s),
q AS MATERIALIZED (
  SELECT *, lag(path) OVER w AS above, lead(path) OVER w AS below FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
n AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, count(DISTINCT below) AS n_children, any_value(above) AS above, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CASE WHEN below IS NULL THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM q GROUP BY path, depth),
x AS (SELECT DISTINCT a.path AS top, b.path FROM p AS a JOIN p AS b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
u AS (SELECT top, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM x JOIN n USING (path) GROUP BY top)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u ON u.top = n.path LEFT JOIN n AS m ON m.path = n.above
"""
