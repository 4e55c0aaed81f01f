"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import saved

#: Sources up to this number are broadcast with their rates, a kilobyte each; more are joined by shuffling.
BROADCAST_SOURCES = 10_000
#: Largest mean inverted at once; a larger one is a sum of independent draws.
PART = 32.0
#: Terms of a distribution of mean PART or less; the rest weighs under 2**-52.
TERMS = 120


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from md5 of seed and parts; null is the empty text."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def rates(documents: DataFrame, weights: dict[str | None, float] | None, temperature: float, budget: float | None) -> DataFrame:
    """(source, rate): mean number of copies of each document of a source.

    ``weights`` are the sources' shares of the result; sources not named get none. Without
    weights, a source weighs its number of documents to the power ``temperature``. ``budget``
    is the mean number of rows wanted, by default the number of documents.
    """
    sizes = documents.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        spark = documents.sparkSession
        given = spark.createDataFrame(list(weights.items()), f"named {documents.schema['source'].dataType.simpleString()}, w double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named").na.fill({"w": 0.0})
    total = sizes.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    wanted = F.col("all_n").cast("double") if budget is None else F.lit(float(budget))
    return sizes.join(F.broadcast(total)).select(  # one row
        F.col("source").alias("_source"),
        F.when(F.col("all_w") > 0, wanted * F.col("w") / F.col("all_w") / F.col("n")).otherwise(0.0).alias("_rate"),
    )


def mix_sources(
    documents: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    budget: float | None = None,
    seed: int = 42,
    shuffled: bool = True,
) -> DataFrame:
    """All columns of ``documents`` with copy, n_copies, rate and shuffle_key.

    Each document is there as often as a Poisson variable with its source's mean rate says,
    inverted from a number hashed from seed and doc_id: any executor that repeats a task
    draws the same. Copies are exploded and ordered globally by ``shuffle_key``, a hash of
    seed, doc_id and copy: rows are range-partitioned and sorted by it.

    Null doc_id counts as empty text; repeated rows with one doc_id get the same number of
    copies. Rows of null source are a source of their own. An empty table gives no rows.
    Columns of the input named like one of the four new ones are replaced.
    """
    new = {"copy", "n_copies", "rate", "shuffle_key"}
    plain = [c for c in documents.columns if c.lower() not in new]
    terms = rates(documents, weights, temperature, budget)
    terms = terms.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / PART)).cast("int"))
    terms = terms.withColumn("_mean", F.col("_rate") / F.col("_parts")).withColumn(
        "_cdf",
        F.expr(
            f"aggregate(sequence(1, {TERMS}), named_struct('p', exp(-_mean), 'c', array(exp(-_mean))),"
            " (s, k) -> named_struct('p', s.p * _mean / k, 'c', concat(s.c, array(element_at(s.c, -1) + s.p * _mean / k))), s -> s.c)"
        ),
    )
    # One row a source, written once: what it was counted from is not read again.
    terms = saved(terms)
    if terms.count() <= BROADCAST_SOURCES:
        terms = F.broadcast(terms)
    draws = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda j: uniform(seed, F.col("_id"), j))
    # How many terms of the cumulated distribution a draw reaches is its Poisson variable.
    number = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("_cdf", lambda c: c <= u)))
    counted = (
        documents.select(F.struct(*[F.col(f"`{c}`") for c in plain]).alias("_row"), F.col("source").alias("_own"), F.col("doc_id").alias("_id"))
        .join(terms, F.col("_own").eqNullSafe(F.col("_source")))
        .withColumn("_n", number.cast("long"))
        .filter("_n > 0")
    )
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(
        "_row.*", "copy", F.col("_n").alias("n_copies"), F.col("_rate").alias("rate"),
        uniform(seed + 1, F.col("_id"), F.col("copy")).alias("shuffle_key"),
    )
    if not shuffled:
        return copies
    return copies.repartitionByRange("shuffle_key", "doc_id", "copy").sortWithinPartitions("shuffle_key", "doc_id", "copy")


SQL = f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n, pow(count(*), 0.5) AS w FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM s) * w / (SELECT sum(w) FROM s) / n AS rate FROM s),
p AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
  UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p WHERE k < {TERMS}),
u AS (SELECT doc_id, source, ('0x' || substr(md5('42:' || doc_id || ':1'), 1, 13))::BIGINT / pow(2, 52) AS u FROM documents),
n AS (SELECT u.doc_id, u.source, p.rate, count(*) AS n_copies FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source AND p.c <= u.u GROUP BY ALL)
SELECT doc_id, source, lang, n_chars, text_md5, copy, n_copies, round(rate, 6) AS rate,
       ('0x' || substr(md5('43:' || doc_id || ':' || copy), 1, 13))::BIGINT / pow(2, 52) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM n)
JOIN (SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents) USING (doc_id)
"""
