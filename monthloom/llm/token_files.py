"""Token-ID output: raw id payloads with a minimal perfect hash index of document keys."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from functools import cache
from itertools import accumulate
from struct import Struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import Memo, in_arrow, saved, scratch

#: Bytes of ids in one row of a payload file.
BLOCK_BYTES = 1 << 20
#: Documents of one shard file, on average.
SHARD_DOCUMENTS = 20_000
#: Keys of one part of the index, on average.
INDEX_KEYS = 100_000
#: Unicode's white space, as the vocabulary's own pattern has it, inside a class.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs between which the vocabulary's pattern always splits, see ``Encoder``.
RUN = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Inside a run: between a Latin letter or digit and ASCII punctuation other than the apostrophe,
#: which can begin a contraction, the pattern always splits as well.
PLAIN, MARK = "0-9A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f", r"!-&(-/:-@\[-`{-~"
INNER = re.compile(f"(?<=[{PLAIN}])(?=[{MARK}])|(?<=[{MARK}])(?=[{PLAIN}])")
#: What the pattern makes one word of, certainly.
WORD = re.compile(" ?[A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f]+")
#: White space other than spaces and line ends, or what ``str.split`` takes for it.
OTHER_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
OTHER_ASCII = "".join(filter(str.isascii, OTHER_SPACE))
REMEMBERED = 64


def byte_symbols() -> dict[int, str]:
    """The public byte-level convention: printable bytes stand for themselves, others for 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts by the tokenizers library, whose results for parts are remembered.

    The vocabulary's pattern never joins characters on both sides of a run of non-spaces
    with at most one space before it; nor do merges leave what the pattern joined. So the ids
    of a text are those of its runs, one after the other. Texts that hold an added token are
    encoded whole.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.packed = [Struct(f"<{n}{'H' if size <= 1 << 16 else 'I'}").pack for n in range(REMEMBERED)]
        self.model, self.symbols = self.tokenizer.model, byte_symbols()
        self.parts = Memo(self._part, 200_000)
        self.runs = Memo(self._run, 100_000)
        self.spaced = Memo(lambda word: self._run(" " + word), 450_000)

    def _pack(self, ids: list[int]) -> bytes:
        return self.packed[len(ids)](*ids) if len(ids) < REMEMBERED else np.array(ids, self.kind).tobytes()

    def _ids(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Of what the pattern makes one word of: straight to the library's merges."""
        if word.isascii():  # letters stand for themselves
            shown = word.replace(" ", self.symbols[32])
        else:
            shown = word.encode().decode("latin-1").translate(self.symbols)
        return self._pack([t.id for t in self.model.tokenize(shown)])

    def _part(self, part: str) -> bytes:
        return self._word(part) if WORD.fullmatch(part) else self._ids(part)

    def _run(self, run: str) -> bytes:
        if WORD.fullmatch(run):  # remembered as a run already
            return self._word(run)
        parts = self.parts
        return b"".join([parts[p] if len(p) <= REMEMBERED else self._part(p) for p in INNER.split(run)])

    def encode(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return self._ids(text)
        runs = self.runs
        if not uneven(text):
            out, spaced = [], self.spaced
            for k, line in enumerate(text.split("\n")):
                if k:
                    out.append(runs["\n"])
                words = line.split(" ")
                if len(line) > 5_000 and max(map(len, words)) > REMEMBERED:
                    out += [runs[r] if len(r) <= REMEMBERED else self._run(r) for r in RUN.findall(line)]
                    continue
                if words[0]:
                    out.append(runs[words[0]])
                out += map(spaced.__getitem__, words[1:])
            return b"".join(out)
        found = RUN.findall(text)
        if found and max(map(len, found)) > REMEMBERED:
            return b"".join([runs[r] if len(r) <= REMEMBERED else self._run(r) for r in found])
        return b"".join(map(runs.__getitem__, found))


def uneven(text: str) -> bool:
    """Whether there is white space other than single spaces and line ends between other characters."""
    return (
        text.startswith(" ") or text.endswith((" ", "\n")) or any(pair in text for pair in ("  ", "\n\n", "\n ", " \n"))
        or any(c in text for c in (OTHER_ASCII if text.isascii() else OTHER_SPACE))
    )


@cache
def encoder(file: str) -> Encoder:
    """One encoder, with what it remembers, for all tasks of a worker."""
    return Encoder(file)


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing function (multiply, shift, exclusive or), by seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays.

    A key takes the bit of its hash at the first level where no other key has the same; its
    number is how many bits come before. Twice as many bits as keys are left give about three
    bits a key in all. A lookup reads a few words, however many keys there are.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.sizes = [len(x) * 64 for x in levels]
        joined = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        self.words = joined
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(joined).astype(np.int64))])
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.asarray(keys, dtype=np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys are not distinct")
        while len(left):
            size = max(1, -(-2 * len(left) // 64))
            place = mix64(left, len(levels)) % np.uint64(size * 64)
            counts = np.bincount(place.astype(np.int64), minlength=size * 64)
            alone = counts == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[place.astype(np.int64)]]
            if len(levels) > 200:
                raise ValueError("keys do not separate")
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level has it. Keys not built in may get any number."""
        keys = np.asarray(keys, dtype=np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, level in enumerate(self.levels):
            if not len(open_):
                break
            place = mix64(keys[open_], k) % np.uint64(self.sizes[k])
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            value = level[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = self.before[self.starts[k] + word[hit]] + below
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<u8")
        return head.tobytes() + self.words.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        words = np.frombuffer(data, "<u8")
        n = int(words[0])
        ends = np.cumsum([0, *words[1 : n + 1].astype(int)]) + n + 1
        return cls([words[a:b].astype(np.uint64) for a, b in zip(ends, ends[1:])])


def _bounds(documents: DataFrame, n_shards: int) -> list[tuple]:
    """Lower bounds of all shards but the first, from about 200 rows a shard picked by hash."""
    if n_shards < 2:
        return []
    tie = F.xxhash64("text")
    picked = (
        documents.select("doc_id", tie.alias("tie"))
        .withColumn("dice", F.pmod(F.xxhash64("tie", "doc_id"), F.lit(1 << 30)))
        .filter(F.col("dice") < int((1 << 30) * min(1.0, 200 / SHARD_DOCUMENTS)))
        .select("doc_id", "tie")
    )
    rows = sorted(((r[0] is not None, r[0], r[1]) for r in picked.collect()), key=lambda r: (r[0], r[1] if r[0] else 0, r[2]))
    return [rows[k * len(rows) // n_shards] for k in range(1, n_shards)] if rows else []


def write_ids(documents: DataFrame, tokenizer_file: str, end_id: int, folder: str, shard_documents: int = SHARD_DOCUMENTS) -> None:
    """Encodes all texts, each followed by ``end_id``, and writes ``folder/payload``.

    A row of a file is a block: (shard, block, first, doc_ids, offsets, sizes, ids). ``ids`` are
    little-endian unsigned integers of about BLOCK_BYTES bytes, whole documents one after the
    other; ``first`` counts the shard's ids before the block, ``offsets`` and ``sizes`` say
    where each document begins in the block and how many ids it has. Shards hold ascending
    ranges of (doc_id, hash of the text), blocks inside them too: rows of one doc_id can spread
    over shards. Null ids come first. Texts are encoded where they are read, so that only
    ids are shuffled.
    """
    n = documents.select("doc_id").count()
    n_shards = max(1, -(-n // shard_documents))
    kind = documents.schema["doc_id"].dataType.simpleString()
    bounds = documents.sparkSession.sparkContext.broadcast([(r[0], r[1] if r[0] else 0, r[2]) for r in _bounds(documents, n_shards)])

    def encode(batches):
        e, lower = encoder(tokenizer_file), bounds.value
        end = np.array([end_id], e.kind).tobytes()
        for batch in batches:
            keys = [(k is not None, 0 if k is None else k, t) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            ids = [e.encode(raw.decode("utf-8", "replace")) + end if raw else end for raw in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect_right(lower, k) for k in keys], pa.int32()), batch.column(0), batch.column(1), pa.array(ids, pa.binary())],
                names=["shard", "doc_id", "tie", "ids"],
            )

    width = encoder(tokenizer_file).kind.itemsize

    def blocks(batches):
        encoder.cache_clear()  # all texts are encoded
        shard = None
        first = block = 0
        keys, sizes, ids = [], [], bytearray()

        def row():
            offsets = np.cumsum([0, *sizes])[:-1]
            one = lambda value, form: pa.array([value], form)
            return pa.RecordBatch.from_arrays(
                [one(shard, pa.int32()), one(block, pa.int64()), one(first, pa.int64()), pa.ListArray.from_arrays([0, len(keys)], pa.array(keys, id_type)),
                 one(offsets.tolist(), pa.list_(pa.int64())), one(sizes, pa.list_(pa.int64())), one(bytes(ids), pa.binary())],
                names=["shard", "block", "first", "doc_ids", "offsets", "sizes", "ids"],
            )

        for batch in batches:
            id_type = batch.column(1).type
            for number, key, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if keys and (number != shard or len(ids) >= BLOCK_BYTES):
                    yield row()
                    first, block = first + len(ids) // width, block + 1
                    keys, sizes, ids = [], [], bytearray()
                if number != shard:
                    shard, first, block = number, 0, 0
                keys.append(key)
                sizes.append(len(payload) // width)
                ids += payload
        if keys:
            yield row()

    texts = documents.select("doc_id", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("text"))
    encoded = in_arrow(texts, encode, f"shard int, doc_id {kind}, tie long, ids binary")
    dealt = encoded.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie")
    in_arrow(dealt, blocks, PAYLOAD.format(id=kind)).write.option("compression", "zstd").parquet(f"{folder}/payload")


PAYLOAD = "shard int, block long, first long, doc_ids array<{id}>, offsets array<long>, sizes array<long>, ids binary"


def directory_of(payload: DataFrame) -> DataFrame:
    """(doc_id, copy, shard, block, offset, n_tokens) of all documents; payloads aren't read.

    ``copy`` numbers the rows of one doc_id from 0, in the order of the files.
    """
    each = payload.select("shard", "block", F.explode(F.arrays_zip("doc_ids", "offsets", "sizes")).alias("d"))
    order = Window.partitionBy(F.col("d.doc_ids")).orderBy("shard", "block", F.col("d.offsets"))
    return each.select(
        F.col("d.doc_ids").alias("doc_id"), (F.row_number().over(order) - 1).cast("long").alias("copy"),
        "shard", "block", F.col("d.offsets").alias("offset"), F.col("d.sizes").alias("n_tokens"),
    )


PLACES = (("shard", "<i4"), ("block", "<i8"), ("offset", "<i8"), ("n_tokens", "<i8"))


def with_key(frame: DataFrame, parts: int) -> DataFrame:
    """Adds ``part`` of the index and, hashed otherwise, ``key`` inside it of (doc_id, copy)."""
    identity = [F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("copy")]
    return frame.withColumn("key", F.xxhash64(F.lit(1), *identity)).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(2), *identity), F.lit(parts)).cast("int")
    )


def build_index(directory: DataFrame, folder: str, index_keys: int = INDEX_KEYS) -> None:
    """Writes ``folder/index``: a minimal perfect hash for each part of the keys.

    A row (part, parts, hash, fingerprint, shard, block, offset, n_tokens) holds the hash and,
    in the order of its numbers, 32-bit fingerprints and places. Keys are distinct and dealt to
    parts by hash, so parts are of bounded size.
    """
    parts = max(1, -(-directory.count() // index_keys))

    def build(frame):
        keys = frame["key"].to_numpy().astype(np.uint64)
        perfect = PerfectHash.build(keys)
        place = np.empty(len(keys), np.int64)
        place[perfect.numbers(keys)] = np.arange(len(keys))
        row = {"part": int(frame["part"].iloc[0]), "parts": parts, "hash": perfect.to_bytes()}
        row["fingerprint"] = fingerprints(keys)[place].tobytes()
        row |= {name: frame[name].to_numpy().astype(form)[place].tobytes() for name, form in PLACES}
        return pd.DataFrame([row])

    schema = "part int, parts int, hash binary, fingerprint binary, shard binary, block binary, offset binary, n_tokens binary"
    keyed = with_key(directory, parts).drop("doc_id", "copy")
    keyed.groupBy("part").applyInPandas(build, schema).write.parquet(f"{folder}/index")


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 999) >> np.uint64(32)).astype("<u4")


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """``keys`` (doc_id, copy) with shard, block, offset, n_tokens from the index.

    Each part of the index meets the keys dealt to it; a number counts only if the stored
    fingerprint is the key's, else the places are null.
    """
    index = keys.sparkSession.read.parquet(f"{folder}/index")
    parts = index.agg(F.max("parts")).first()[0] or 1
    kind = keys.schema["doc_id"].dataType.simpleString()
    asked = with_key(keys, parts).withColumn("doc_id", F.col("doc_id").cast("string"))

    def find(left, right):
        ok, values = np.zeros(len(left), bool), {name: np.zeros(len(left), np.int64) for name, _ in PLACES}
        if len(left) and len(right):
            row, wanted = right.iloc[0], left["key"].to_numpy().astype(np.uint64)
            number = PerfectHash.from_bytes(row["hash"]).numbers(wanted)
            ok = number >= 0
            number[~ok] = 0
            ok &= np.frombuffer(row["fingerprint"], "<u4")[number] == fingerprints(wanted)
            values = {name: np.frombuffer(row[name], form)[number].astype(np.int64) for name, form in PLACES}
        places = {name: pd.arrays.IntegerArray(v, ~ok) for name, v in values.items()}
        return pd.DataFrame({"doc_id": left["doc_id"], "copy": left["copy"], **places})

    found = asked.groupBy("part").cogroup(index.groupBy("part")).applyInPandas(
        find, "doc_id string, copy long, shard long, block long, offset long, n_tokens long"
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def read_ids(places: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """``places`` with crc32 of the ids as 32-bit integers and, if asked for, the ids.

    Each block meets the places inside it once; only the bytes of a document are touched.
    """
    kind = places.schema["doc_id"].dataType.simpleString()
    payload = places.sparkSession.read.schema(PAYLOAD.format(id=kind)).parquet(f"{folder}/payload")
    wide = places.withColumn("doc_id", F.col("doc_id").cast("string"))

    def cut(left, right):
        sums, ids = np.zeros(len(left), np.int64), []
        if len(left):
            row = right.iloc[0]
            values = np.frombuffer(row["ids"], f"<u{len(row['ids']) // max(1, int(row['total']))}")
            for k, (start, n) in enumerate(zip(left["offset"].tolist(), left["n_tokens"].tolist())):
                part = values[start : start + n].astype("<u4")
                sums[k] = zlib.crc32(part.tobytes())
                if with_ids:
                    ids.append(part.astype(np.int64))
        out = left.assign(ids_crc32=sums, first=int(right["first"].iloc[0]) if len(right) else 0)
        return out.assign(ids=ids) if with_ids else out

    names = ["doc_id", "copy", "shard", "block", "offset", "n_tokens"]
    schema = "doc_id string, copy long, shard long, block long, offset long, n_tokens long, ids_crc32 long, first long"
    blocks = payload.select(F.col("shard").cast("long"), "block", "first", "ids", F.aggregate("sizes", F.lit(0).cast("long"), lambda n, s: n + s).alias("total"))
    found = wide.select(*names).groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block")).applyInPandas(
        cut, schema + ", ids array<long>" * with_ids
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def encode_to_files(documents: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Writes payload and index of all documents and reads every document back by its key.

    Returns (doc_id, copy, start, n_tokens, ids_crc32): ``start`` counts the ids of all documents
    before, ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers. ``folder``
    is where the files go, by default a new one in the shared folder.

    Null and empty texts have the end id only. A null doc_id sorts first; rows of one doc_id
    are ordered by a hash of the text and numbered by ``copy``. An empty table gives no rows.
    Other columns are ignored.
    """
    spark = documents.sparkSession
    folder = folder or scratch(spark)
    write_ids(documents, tokenizer_file, end_id, folder)
    kind = documents.schema["doc_id"].dataType.simpleString()
    payload = spark.read.schema(PAYLOAD.format(id=kind)).parquet(f"{folder}/payload")
    directory = saved(directory_of(payload))
    build_index(directory, folder)
    found = read_ids(locate(directory.select("doc_id", "copy"), folder), folder)
    # A row for each shard file.
    totals = directory.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before = accumulate([0, *(r["n"] for r in totals)])
    firsts = spark.createDataFrame([(r["shard"], b) for r, b in zip(totals, before)], "shard long, before long")
    return found.join(firsts, "shard").select(
        "doc_id", "copy", (F.col("before") + F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
