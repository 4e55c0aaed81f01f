"""URL filter: rules, then naive Bayes on the words of host and path.

Names in hosts are concatenated words. A unigram Viterbi search splits them: words are counted
in the texts of all pages, a piece that is no such word costs more the longer it is, and the
split of the largest product of probabilities is taken. Multinomial naive Bayes then weighs the
words of the host and the path. It starts from two short word lists (parameters) and learns
from the hosts without labels: hosts weighted by their probability give the counts of the next
round, a fixed number of rounds. Both classes are smoothed with all words alike, so that words
they share say nothing. A host counts once, whatever its share of the pages, and so does a word
in a host or a path. Rules are no evidence: they judge places, not words.

Only words that occur in some name are joined to their counts; neither the vocabulary nor the
model is held in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import in_arrow, saved

#: Verdict and place (host with its subdomains, start of the path); the longest that fits decides.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words to start from. Fixed values.
UNWANTED = (
    "ad ads adult bet bets betting bonus casino cheap click clicks coupon crack deals diet dating discount escort free gambling "
    "jackpot keygen loan loans lottery malware nude payday phishing pill pills poker popup porn prize replica scam sex slots "
    "spam sweepstakes torrent track tracker tracking viagra warez win winner xxx"
).split()
WANTED = "academy archive college docs edu encyclopedia forum gov health journal library museum news school science university weather wiki".split()
#: Share of its list in the word probabilities of a class; the rest is learned.
LIST_SHARE = 0.5
#: Words of the background that each class is smoothed with; occurrences added to each of its words.
SMOOTHING, UNSEEN = 20.0, 0.1
#: Log-odds of a place to be unwanted before its words are read.
PRIOR = -2.0
#: Occurrences that a listed word counts for when names are split.
LISTED_COUNT = 10
ROUNDS = 3
#: Letters of the longest piece that a split considers.
LONGEST = 24
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters, and runs of digits.
_TOKEN = r"(\p{L}+|\p{N}+)"


def located(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of each url; both empty for null and for an url without ``://``."""
    found = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(found, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(found, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", host.alias("host"), path.alias("path"))


def decided(rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host and path, or null."""
    choices = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r)):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        choices.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*choices) if choices else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters of a text; a run of digits is ``#``."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN)), lambda x: F.when(x.rlike(r"^\p{N}"), "#").otherwise(x))


def word_counts(pages: DataFrame, words: Sequence[str]) -> DataFrame:
    """(word, n) of all words up to LONGEST letters in the texts of pages, and of ``words``.

    Only words that stand alone between white space count: an address in a text is no word.
    """
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^<>]*>", " "))
    runs = pages.select(F.explode(F.split(text, r"\s+")).alias("run"))
    found = runs.select(F.regexp_extract("run", r"^\P{L}*(\p{L}+)\P{L}*$", 1).alias("word")).filter((F.length("word") <= LONGEST) & (F.col("word") != ""))
    counted = found.groupBy("word").agg(F.count("*").alias("n"))
    listed = pages.sparkSession.createDataFrame([(w, LISTED_COUNT) for w in sorted(set(words))], "word string, n long")
    return counted.unionByName(listed).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(length: int, known: dict[int, dict[int, float]], total: float) -> list[int]:
    """Ends of the pieces of the most probable split; of equal ones that of fewer pieces.

    ``known``: by start and length, the log-probability of words.
    """
    best, back = [(-math.inf, 0)] * (length + 1), [0] * (length + 1)
    best[0] = (0.0, 0)
    for start in range(length):
        score, pieces = best[start]
        words = known.pop(start, {})
        for size in range(1, min(LONGEST, length - start) + 1):
            p = words.get(size)
            if p is None:
                p = math.log(10.0 / total) - size * math.log(10.0)
            reached = (score + p, pieces - 1)
            if reached > best[start + size]:
                best[start + size], back[start + size] = reached, start
    ends, at = [], length
    while at:
        ends.append(at)
        at = back[at]
    return ends[::-1]


def _splits(total: float):
    """Words of each name from its candidates, which come together."""
    kind = pa.schema([("name", pa.string()), ("words", pa.list_(pa.string()))])

    def run(batches):
        name, known = None, {}

        def split():
            ends = best_split(len(name), known, total)
            return {"name": name, "words": [name[i:j] for i, j in zip([0, *ends], ends)]}

        for batch in batches:
            done = []
            for own, start, size, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if own != name:
                    if name is not None:
                        done.append(split())
                    name, known = own, {}
                if n is not None:
                    known.setdefault(start, {})[size] = math.log(n / total)
            yield pa.RecordBatch.from_pylist(done, kind)
        if name is not None:
            yield pa.RecordBatch.from_pylist([split()], kind)

    return run


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct ``names``; ``counts``: (word, n)."""
    total = float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    starts = names.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("name") - 1)))
    pieces = starts.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("start")))))
    pieces = pieces.withColumn("word", F.col("name").substr(F.col("start") + 1, F.col("size")))
    found = pieces.join(counts, "word").select("name", "start", "size", "n")
    # A row of its own for each name, for those in which no word occurs.
    every = names.select("name", F.lit(-1).alias("start"), F.lit(0).alias("size"), F.lit(None).cast("long").alias("n"))
    dealt = found.unionByName(every).repartition("name").sortWithinPartitions("name", "start")
    return in_arrow(dealt, _splits(max(total, 10.0)), "name string, words array<string>")


def log_ratio(model: DataFrame) -> DataFrame:
    """(word, ratio): log of the word's probability in unwanted over that in wanted places.

    ``model``: word, n (occurrences), in_unwanted and in_wanted (share in the list), unwanted
    and wanted (occurrences weighted by the hosts' probabilities).
    """
    of = model.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("n", "unwanted", "wanted")], F.count("*").alias("v")).first()
    background = (F.col("n") + UNSEEN) / (of["n"] + UNSEEN * of["v"])

    def probability(kind):
        learned = (F.col(kind) + SMOOTHING * background) / (of[kind] + SMOOTHING)
        return LIST_SHARE * F.col(f"in_{kind}") + (1 - LIST_SHARE) * learned

    return model.select("word", F.log(probability("unwanted") / probability("wanted")).alias("ratio"))


def summed(bags: DataFrame, ratios: DataFrame, key: str) -> DataFrame:
    """(key, score): log-odds of the distinct words (key, word) of each key."""
    return bags.join(ratios, "word").groupBy(key).agg(F.sum("ratio").alias("score"))


def learned(sites: DataFrame, paths: DataFrame, unwanted: Sequence[str], wanted: Sequence[str], rounds: int) -> DataFrame:
    """(word, ratio) after ``rounds`` over all hosts.

    ``sites``: distinct (host, word) of the host's own words; ``paths``: those of paths below it.
    """
    spark = sites.sparkSession
    listed = [(w, (w in unwanted) / len(unwanted), (w in wanted) / len(wanted)) for w in sorted({*unwanted, *wanted})]
    lists = spark.createDataFrame(listed, "word string, in_unwanted double, in_wanted double").withColumn("n", F.lit(0.0))
    bags = saved(sites.unionByName(paths))
    none = F.lit(0.0)
    counted = bags.select("word", F.lit(1.0).alias("n"), none.alias("in_unwanted"), none.alias("in_wanted"))
    words = lists.unionByName(counted)
    words = saved(words.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "in_unwanted", "in_wanted")]))
    model = words.withColumns({"unwanted": none, "wanted": none})
    for _ in range(rounds):
        scored = summed(sites, log_ratio(model), "host").select("host", (1 / (1 + F.exp(-(F.col("score") + PRIOR)))).alias("share"))
        counts = (
            bags.join(scored, "host")
            .groupBy("word")
            .agg(F.sum("share").alias("unwanted"), F.sum(1 - F.col("share")).alias("wanted"))
        )
        model = saved(words.join(counts, "word", "left").na.fill({"unwanted": 0.0, "wanted": 0.0}))
    return saved(log_ratio(model))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    unwanted: Sequence[str] = tuple(UNWANTED),
    wanted: Sequence[str] = tuple(WANTED),
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, score, host_words.

    ``verdict`` is that of the longest rule that fits (``rule``, else null); else ``block`` if
    ``score``, the log-odds after reading the words of host and path, is above zero, else ``allow``.

    A null url, or one without ``://``, has empty host and path and is allowed. Null html holds
    no words. Urls and texts may be of any length, names are split over their whole length;
    repeated rows are judged alike, each with a row of its own; rules of equal length go by
    their text. An empty table gives no rows. Columns other than page_id, url, html are ignored.
    """
    placed = saved(located(pages).withColumn("of", decided(rules)).select("page_id", "host", "path", F.col("of.rule").alias("rule"), F.col("of.verdict").alias("ruled")))
    hosts = placed.select("host").distinct().filter("host <> ''")
    # The last label is the registry's, no part of the name.
    named = F.regexp_replace("host", r"\.[^.]*\z", "")
    parts = saved(hosts.select("host", F.posexplode(tokens(named)).alias("place", "name")))
    names = parts.filter("name <> '#'").select("name").distinct()
    split = saved(segmented(saved(names), saved(word_counts(pages, [*unwanted, *wanted]))))
    placed_words = parts.join(split, "name", "left").select(
        "host", "place", F.coalesce("words", F.array("name")).alias("words")
    )
    shown = placed_words.groupBy("host").agg(
        F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: x["words"])), " ").alias("host_words")
    )
    shown = saved(shown)
    sites = saved(shown.select("host", F.explode(F.split("host_words", " ")).alias("word")).distinct())
    ways = saved(placed.select("path").distinct().select("path", F.explode(tokens(F.col("path"))).alias("word")).distinct())
    below = placed.select("host", "path").distinct().join(ways, "path").select("host", "word").distinct()
    ratios = learned(sites, below.filter("host <> ''"), unwanted, wanted, rounds)
    by_host = shown.join(summed(sites, ratios, "host"), "host", "left").withColumnRenamed("score", "host_score")
    by_path = summed(ways, ratios, "path").withColumnRenamed("score", "path_score")
    score = F.when(F.col("host") == "", F.lit(PRIOR)).otherwise(PRIOR + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0)))
    return (
        placed.join(by_host, "host", "left").join(by_path, "path", "left").withColumn("score", score)
        .select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score",
                F.coalesce("host_words", F.lit("")).alias("host_words"))
    )
