"""Token counts: the exact count at every prefix of a text, by dynamic programming."""

from __future__ import annotations

import re
from array import array
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import Memo, in_arrow

#: Parts of a line that no piece crosses: a run of spaces with what follows it.
UNIT = re.compile(r" *[^ ]+| +")
#: Longer parts are counted anew each time instead of being remembered.
REMEMBERED = 64
LINE_END = bytes([0, 1])


class PrefixCounter:
    """Token counts at every prefix, for a pair-merging vocabulary with byte fallback.

    The last token of the encoding of a prefix that ends at i is the one token t ending there
    that stands next to the last token of the prefix before t in an encoding of its own: an
    encoding is right exactly if all its adjacent pairs are. So
    ``count[i] = count[i - len(t)] + tokens of t``, and one pass gives all prefixes. Pieces
    hold a space at their start only, so parts of a text that begin with spaces are counted
    independently and remembered.
    """

    def __init__(self, model_file: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        self.scores: dict[str, float] = {}
        for i in range(model.vocab_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                piece = model.id_to_piece(i).replace("▁", " ")
                if piece.lstrip(" ").find(" ") >= 0 or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses the parts that are counted independently")
                self.scores[piece] = model.get_score(i)
        self.longest = max(map(len, self.scores), default=1)
        #: Neighbours inside some piece; nothing merges across other neighbours.
        self.inside = {piece[k : k + 2] for piece in self.scores for k in range(len(piece) - 1)}
        self.pairs = Memo(self._stand_together)
        self.whole = Memo(self._whole, 300_000)
        self.parts = Memo(self._joined, 300_000)
        self.spaced = Memo(lambda word: self._joined(" " + word), 600_000)

    def _stand_together(self, pair: tuple[str, str]) -> bool:
        """Whether merging the pair's characters, best piece first, gives the pair again."""
        symbols, scores = list("".join(pair)), self.scores
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = scores.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return tuple(symbols) == pair

    def _whole(self, part: str) -> bytes | array:
        """Tokens of each prefix of a part, the empty one first."""
        scores, pairs, longest = self.scores, self.pairs, self.longest
        counts, last = [0], [""]
        for end in range(1, len(part) + 1):
            for start in range(max(0, end - longest), end):
                token = part[start:end]
                if token in scores and (not start or pairs[last[start], token]):
                    counts.append(counts[start] + 1)
                    break
            else:  # no piece: bytes, which merge with nothing
                token = part[end - 1]
                counts.append(counts[end - 1] + len(token.encode("utf-8", "surrogatepass")))
            last.append(token)
        return bytes(counts) if max(counts) < 256 else array("I", counts)

    def _joined(self, part: str) -> bytes | array:
        """The same from sections between which nothing merges, such as a word and a comma."""
        inside, start, sections = self.inside, 0, []
        for k in range(1, len(part)):
            if part[k - 1 : k + 1] not in inside:
                sections.append(part[start:k])
                start = k
        sections.append(part[start:])
        if len(sections) == 1:
            return self._whole(part)
        counts, before = [0], 0
        for section in sections:
            more = self.whole[section] if len(section) <= REMEMBERED else self._whole(section)
            counts += [before + c for c in more[1:]]
            before += more[-1]
        return bytes(counts) if max(counts) < 256 else array("I", counts)

    def table(self, text: str) -> list[bytes | array]:
        """The stored counts of the parts of a text, in order; a space is put before the text."""
        out: list[bytes | array] = []
        if not text:
            return out
        parts, spaced = self.parts, self.spaced
        for k, line in enumerate(text.replace("▁", " ").split("\n")):
            if k:
                out.append(LINE_END)
            words = line.split(" ")
            if "" in words or len(line) > 10_000 and max(map(len, words)) > REMEMBERED:
                for part in UNIT.findall(line if k else " " + line):
                    out.append(parts[part] if len(part) <= REMEMBERED else self._joined(part))
            else:
                out.append(parts[words[0]] if k else spaced[words[0]])
                out += map(spaced.__getitem__, words[1:])
        return out

    def counts(self, text: str) -> list[int]:
        """Tokens of ``text[:i]`` for every i from 0."""
        out, before = [0], 0
        for counts in self.table(text):
            out += [before + c for c in counts[1:]]
            before += counts[-1]
        return [0, *out[2:]]  # without the prefix that is the added space alone

    def fitting(self, table: list[bytes | array], limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens, from stored counts."""
        totals = [0, *accumulate(counts[-1] for counts in table)]
        ends = [0, *accumulate(len(counts) - 1 for counts in table)]
        for k in range(len(table) - 1, -1, -1):
            if totals[k] <= limit:
                for c in range(len(table[k]) - 1, 0, -1):
                    if totals[k] + table[k][c] <= limit:
                        return max(0, ends[k] + c - 1)
        return 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """One counter, with what it remembers, for all tasks of a worker."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def count_tokens(documents: DataFrame, model_file: str, limit: int = 4096, with_prefixes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars) of every whole text.

    ``fitting_chars`` is the number of characters of the longest prefix with at most ``limit``
    tokens. ``with_prefixes`` adds ``prefix_counts``, tokens of each prefix from the empty one
    on. Null and empty texts have no bytes and tokens; ids may be null and may repeat: each
    row is counted. An empty table gives no rows; other columns are ignored.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = counter(model_file)
        for batch in batches:
            sizes, totals, fits, prefixes = [], [], [], []
            for raw in batch.column(1).to_pylist():
                text = (raw or b"").decode("utf-8", "replace")
                table = c.table(text)
                sizes.append(len(raw or b""))
                total = sum([counts[-1] for counts in table])
                totals.append(total)
                fits.append(len(text) if total <= limit else c.fitting(table, limit))
                if with_prefixes:
                    prefixes.append(c.counts(text))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, totals, fits))]
            names = ["doc_id", "n_bytes", "n_tokens", "fitting_chars"]
            if with_prefixes:
                columns.append(pa.array(prefixes, pa.list_(pa.int32())))
                names.append("prefix_counts")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_bytes long, n_tokens long, fitting_chars long" + ", prefix_counts array<int>" * with_prefixes
    counted = in_arrow(documents.select("doc_id", F.col("text").cast("binary").alias("text")), run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
