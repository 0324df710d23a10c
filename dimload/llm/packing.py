"""Best-fit packing of tokenized documents into sequences of one length.

Only lengths matter for where a piece goes, and there are no more of them than a
sequence has tokens. So the packing is worked out on the histogram of lengths, for
runs of equal bins at a time, and the pieces are dealt to its slots by their rank
among pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimload.llm.common import Texts, WordIndex, chunks, decided, handing_back, utf8
from dimload.sources.scratch import cut_lineage

CAPACITY = 2048
#: Distinct words that a task keeps the ids of, and bytes of text encoded at a time.
CACHE_WORDS, CHUNK = 600_000, 1 << 19


# How a tokenizer is set up whose words can be encoded apart. It drops white
# space, and splits words into runs of letters, single digits and runs of other characters.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_END_OF_WORD = "</w>"


class Encoder:
    """Token ids of whole texts.

    For a tokenizer set up as above each distinct word (up to ASCII white space) is encoded
    once and then looked up. Most words are of ASCII and Latin letters, digits and signs;
    their case and their pieces are settled for many at a time, and the tokenizer's
    model does the merges. Any other word goes through the whole tokenizer, and for any
    other tokenizer whole texts do."""

    def __init__(self, file: str):
        import json
        import os

        # A task has one core; threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as opened:
            known = json.load(opened)
        splits = (known["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.apart = (
            known["normalizer"] == _NORMALIZER
            and splits[0].get("pattern") == _SPLIT
            and splits[1:] == [_BYTES]
            and known["post_processor"] is None
            and known["model"].get("end_of_word_suffix") == _END_OF_WORD
        )
        if self.apart:
            plain = known | {"normalizer": None, "added_tokens": []}
            plain["pre_tokenizer"] = {"type": "CharDelimiterSplit", "delimiter": " "}
            self.model = Tokenizer.from_str(json.dumps(plain))
            vocabulary = known["model"]["vocab"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(_END_OF_WORD)]] = True
            # Bytes as the model's characters: printable ones stand for themselves, the
            # others, in order, for those from 256 on.
            byte = np.arange(256)
            printable = (byte >= 33) & (byte <= 126) | (byte >= 161) & (byte != 173)
            self.characters = np.where(printable, byte, 255 + np.cumsum(~printable)).astype("<u4")
            self.characters[32] = 32  # between pieces
        self.index = WordIndex(self._learn, self._forget, CACHE_WORDS, CHUNK)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.start, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        codes = _codes(words)
        word = np.cumsum(codes == 10)
        plain = (codes > 32) & (codes < 127) & (codes != 39)
        plain |= (codes >= 0xC0) & (codes <= 0x24F) & (codes != 0xD7) & (codes != 0xF7) & (codes != 0x130)
        plain |= codes == 10
        plain[:-1] &= ~((codes[:-1] == 60) & (codes[1:] == 124))  # the beginning of a special token
        odd = np.zeros(len(words), bool)
        odd[word[~plain]] = True
        other = [w for w, o in zip(words, odd.tolist()) if o]
        plain = [w for w, o in zip(words, odd.tolist()) if not o]
        ids, length = [np.zeros(0, np.uint32)] * 2, np.zeros(len(words), np.int64)
        if other:
            encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in other], add_special_tokens=False)
            found = [np.array(e.ids, np.uint32) for e in encoded]
            ids[0], length[odd] = np.concatenate(found), [len(f) for f in found]
        if plain:
            ids[1], length[~odd] = self._merge(plain)
        # Numbered as they came: each word's ids lie in one of the two arrays.
        start = np.zeros(len(words), np.int64)
        start[odd] = np.cumsum(length[odd]) - length[odd]
        start[~odd] = len(ids[0]) + np.cumsum(length[~odd]) - length[~odd]
        self.start = np.concatenate([self.start, len(self.ids) + start])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, *ids])

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, digits and signs one after the other, and how many each has."""
        codes = _codes(words, lower=True)
        gap = codes == 10
        kind = np.where((codes >= 97) & (codes <= 122) | (codes >= 0xC0), 1, np.where((codes >= 48) & (codes <= 57), 2, 3))
        cut = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut &= ~gap[1:] & ~gap[:-1]
        at = np.flatnonzero(cut) + 1
        pieces = 1 + np.bincount(np.cumsum(gap)[at], minlength=len(words))
        codes = np.insert(np.where(gap, 32, codes), at, 32).astype("<u4")
        data = np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8)
        parts = self.characters[data].tobytes().decode("utf-32-le").split(" ")
        # Short lines: the tokenizer takes longer for each piece of a long one.
        lines = [" ".join(parts[i : i + 48]) for i in range(0, len(parts), 48)]
        encoded = self.model.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in encoded])
        stop = np.flatnonzero(self.ends[ids])[np.cumsum(pieces) - 1] + 1
        return ids, np.diff(np.concatenate([[0], stop]))

    def encode(self, texts: list[bytes], close: int) -> list[np.ndarray]:
        """The ids of each text, then ``close``."""
        end = np.array([close], np.uint32)
        if not self.apart:
            encoded = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.concatenate([np.array(e.ids, np.uint32), end]) for e in encoded]
        row, ends = self.index.rows(texts)
        length = self.length[row]
        total = np.cumsum(length)
        ids = self.ids[np.repeat(self.start[row] - total + length, length) + np.arange(total[-1] if len(total) else 0)]
        total = np.concatenate([[0], total])[np.concatenate([[0], ends])]
        return [np.concatenate([ids[a:b], end]) for a, b in zip(total[:-1].tolist(), total[1:].tolist())]


def _codes(words: list[bytes], lower: bool = False) -> np.ndarray:
    text = b"\n".join(words).decode("utf-8", "replace")
    return np.frombuffer((text.lower() if lower else text).encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(file: str, capacity: int, close: int, keep_ids: bool) -> Callable:
    """Arrow batches of (key columns, text) to pieces with their ids, the task's number
    and each piece's rank among the task's pieces of its length."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, ranks = Encoder(file), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            key = batch.column(0)
            for first, chunk in chunks(Texts(batch.column(1)), CHUNK):
                owner, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
                for i, tokens in enumerate(encoder.encode(chunk, close)):
                    for n, begin in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[begin : begin + capacity].astype("<u4", copy=False)
                        owner.append(first + i)
                        piece.append(n)
                        start.append(begin)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        rank.append(int(ranks[len(part)]))
                        ranks[len(part)] += 1
                        if keep_ids:
                            ids.append(part)
                columns = {
                    "doc_id": key.take(pa.array(owner, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "task": pa.array([task] * len(owner), pa.int32()),
                    "rank": pa.array(rank, pa.int64()),
                }
                if keep_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_pydict(columns)

    return handing_back(tokenize)


def tokenized(
    docs: DataFrame,
    file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    close: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, task, rank, ids``.

    A document is the ids of its text, then ``close``; a NULL text counts as empty.
    Only documents longer than ``capacity`` are cut, into pieces of that many tokens;
    the last may be shorter."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long"
    schema += ", ids array<int>" if keep_ids else ""
    rows = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(_pieces(file, capacity, close, keep_ids), schema)


@dataclass
class Plan:
    """Runs of slots, sorted by (length, first rank): ``bins`` bins from ``bin`` on take
    ``each`` pieces of the length, from ``offset`` on. ``total``: all bins."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    total: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces with these lengths and ranks."""
        first = np.searchsorted(self.length, length, "left")
        last = np.searchsorted(self.length, length, "right")
        while True:  # the last run of the length that begins at or before the rank
            open_ = last - first > 1
            if not open_.any():
                break
            middle = (first + last) // 2
            below = self.rank[np.minimum(middle, len(self.rank) - 1)] <= rank
            first, last = np.where(open_ & below, middle, first), np.where(open_ & ~below, middle, last)
        within = rank - self.rank[first]
        return self.bin[first] + within // self.each[first], self.offset[first] + within % self.each[first] * length


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs a histogram of lengths, 1 to ``capacity``.

    Pieces above a third of the capacity: at most two fit a bin. From the longest down,
    each is matched with the longest other that fits, which makes as many pairs as can
    be. Shorter pieces, from the longest down, go to the bin with the smallest gap that
    holds them; if none does, to new bins. Equal bins are treated together, so the work
    depends on the capacity and not on the number of pieces."""
    left = {n: c for n, c in histogram.items() if c}
    dealt: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs of bins (first, number)
    sizes: list[int] = []  # the gaps in use, sorted
    total = 0

    def put(length: int, first: int, bins: int, each: int, gap: int) -> None:
        """``each`` pieces into each of the bins, whose gap was ``gap``."""
        runs.append((length, dealt[length], first, each, capacity - gap))
        dealt[length] += bins * each
        rest = gap - each * length
        if rest:
            if not gaps[rest]:
                insort(sizes, rest)
            gaps[rest].append((first, bins))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        b = large[at] if at >= 0 else None
        if b is None:
            bins = left[a]
            put(a, total, bins, 1, capacity)
        elif b == a:
            bins, single = divmod(left[a], 2)
            if bins:
                put(a, total, bins, 2, capacity)
                total += bins
            bins = single
            if single:  # the next shorter one may still pair with it
                left[a] = 1
                if at and large[at - 1] <= capacity - a:
                    b = large[at - 1]
                    runs.append((a, dealt[a], total, 1, 0))
                    dealt[a] += 1
                    put(b, total, 1, 1, capacity - a)
                    left[b] -= 1
                    if not left[b]:
                        large.pop(at - 1)
                else:
                    put(a, total, 1, 1, capacity)
        else:
            bins = min(left[a], left[b])
            runs.append((a, dealt[a], total, 1, 0))
            dealt[a] += bins
            put(b, total, bins, 1, capacity - a)
            left[b] -= bins
            if not left[b]:
                large.pop(at)
            left[a] -= bins
            total += bins
            if not left[a]:
                large.pop()
            continue
        total += bins
        large.pop()
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[length]
        while count:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                bins, rest = divmod(count, each)
                if bins:
                    put(length, total, bins, each, capacity)
                if rest:
                    put(length, total + bins, 1, rest, capacity)
                total += bins + (rest > 0)
                break
            gap = sizes[at]
            first, bins = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            each = gap // length
            used = min(bins, count // each)
            back = bins - used
            if used:
                put(length, first, used, each, gap)
                count -= used * each
            if back and count:  # fewer than a bin takes
                put(length, first + used, 1, count, gap)
                used, back, count = used + 1, back - 1, 0
            if back:
                if not gaps[gap]:
                    insort(sizes, gap)
                gaps[gap].append((first + used, back))
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    return Plan(*columns, total)


def _deal(plan: Plan) -> Callable:
    """A column function from length and rank to the place of a piece."""

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        bins, offsets = plan.place(*(x.to_numpy(zero_copy_only=False) for x in (length, rank)))
        return pa.StructArray.from_arrays([pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())], ["sequence_id", "offset"])

    return F.arrow_udf(place, "sequence_id long, offset long")


def pack(
    docs: DataFrame,
    file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    close: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """All of ``docs`` packed: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``
    per piece, with ``ids`` if asked for (``sequences`` puts them together).

    A document is its ids, then ``close`` (a NULL or empty text: ``close`` alone). Pieces
    fill a sequence from offset 0 on without gaps, up to ``capacity`` tokens. Repeated
    rows and ids are packed once for each row; a NULL id stays NULL; other columns are not
    looked at; no rows, no rows.

    Texts are encoded once and the pieces written to the checkpoint folder. Then each
    piece's rank among all pieces of its length is its rank in its task plus the
    number in the tasks before: only counts per task and length meet. Where these fit they are
    copied to the executors and the pieces stay in place (see ``decided``). The driver gets
    the histogram of lengths, ``capacity`` rows at most, and the plan sent to the
    tasks is bounded by ``capacity`` too."""
    found = cut_lineage(tokenized(docs, file, doc_id, text, capacity, close, keep_ids))
    counts = cut_lineage(found.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    before = before.withColumnsRenamed({"length": "__length", "task": "__task"})
    on = (F.col("length") == F.col("__length")) & (F.col("task") == F.col("__task"))
    ranked = decided(found, cut_lineage(before), on, "inner", F.lit(0))
    placed = ranked.withColumn("at", _deal(plan)("length", F.col("rank") + F.col("before")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    return placed.select(*names, "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_starts``: the token ids of each sequence, and where its pieces
    begin. ``packed`` must have ``ids``; a sequence is bounded by the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("doc_starts"))
