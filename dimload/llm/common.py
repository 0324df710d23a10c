"""What several operators share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: code points other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: Column | str) -> Column:
    """The bytes of a text; Python gets them without decoding, NULL stays NULL."""
    return (F.col(text) if isinstance(text, str) else text).cast("binary")


def words(text: Column | str) -> Column:
    """All words in order; a NULL text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def text_key(text: Column | str) -> Column:
    """Sixty bits of the MD5 of a text, as a long; equal texts are one content. NULL gives -1."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.conv(F.substring(F.md5(utf8(text)), 1, 15), 16, 10).cast("long"), F.lit(-1).cast("long"))


def fold(row_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return (F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def share_below(key: Column, share: Column | float) -> Column:
    """Whether the row is among a pseudorandom ``share`` of all rows, by its key alone."""
    return F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1 << 30)) < F.lit(float(1 << 30)) * share


def hand_back() -> None:
    """Return memory that is free to the system. Spark keeps a Python worker for later tasks,
    and with it, idle or not, all that the worker's allocators hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def handing_back(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``f`` over the batches of a task; what it held is returned before the task ends."""

    def over(batches):
        yield from f(batches)
        hand_back()

    return over


_WHITE = re.compile(rb"[\x09-\x0d ]")


class WordIndex:
    """Numbers the distinct words of texts, for what is worked out once a word.

    Words are byte strings up to one of the six ASCII white-space characters. They are
    known by 64 bits: a polynomial hash and the length of up to ``LONG`` bytes, BLAKE2 of
    longer ones; both by keys drawn for the index, so no text can hold a pair of words made to agree.
    ``learn`` gets new words in the order of their numbers. The index
    empties itself, and calls ``forget``, before it holds many more than ``most`` words.
    Texts are looked at in windows of ``window`` bytes at most; a longer word alone, by its BLAKE2."""

    LONG = 48

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None], most: int, window: int):
        self.learn, self.forget, self.most, self.window = learn, forget, most, window
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverse = np.ones(1, np.uint64)
        self.base, self.key = int.from_bytes(os.urandom(8), "little") | 1, os.urandom(16)

    def _long(self, word: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.key).digest(), "little")

    def _prepare(self, n: int) -> None:
        if len(self.powers) <= n:
            steps = np.full(n + 1, self.base, np.uint64), np.full(n + 1, pow(self.base, -1, 1 << 64), np.uint64)
            for s in steps:
                s[0] = 1
            self.powers, self.inverse = (np.multiply.accumulate(s) for s in steps)

    def _window(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        solid = np.concatenate([[False], ~self.white[data], [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        start, stop = edge[::2], edge[1::2]
        if not len(start):
            return start, start
        self._prepare(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        length = stop - start
        key = (sums[stop] - sums[start]) * self.inverse[start] ^ (length.astype(np.uint64) << np.uint64(57))
        for i in np.flatnonzero(length > self.LONG).tolist():
            key[i] = self._long(text[start[i] : stop[i]])
        return start, self._numbered(text, start, stop, key)

    def _numbered(self, text: bytes, start: np.ndarray, stop: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The numbers of words with these keys; new ones are learned."""
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        key, first = key[new], order[new]
        place = np.searchsorted(self.keys, key)
        if len(self.keys):
            unknown = self.keys[np.minimum(place, len(self.keys) - 1)] != key
        else:
            unknown = np.ones(len(key), bool)
        number = np.empty(len(key), np.int64)
        number[~unknown] = self.numbers[place[~unknown]]
        if unknown.any():
            at = first[unknown]
            number[unknown] = len(self.keys) + np.arange(len(at))
            self.learn([text[a:b] for a, b in zip(start[at].tolist(), stop[at].tolist())])
            self.keys = np.insert(self.keys, place[unknown], key[unknown])
            self.numbers = np.insert(self.numbers, place[unknown], number[unknown])
        row = np.empty(len(order), np.int64)
        row[order] = number[np.cumsum(new) - 1]
        return row

    def rows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words in order, and where in them each text ends."""
        if len(self.keys) > self.most:
            self.keys, self.numbers = self.keys[:0], self.numbers[:0]
            self.forget()
        whole = b"\n".join(texts)
        places, rows, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while at < len(whole):
            to = min(at + self.window, len(whole))
            if to < len(whole) and not self.white[whole[to]]:  # a word goes on: it is left to the next window
                gaps = np.flatnonzero(self.white[np.frombuffer(whole, np.uint8, to - at, at)])
                gap = None if len(gaps) else _WHITE.search(whole, to)
                to = at + int(gaps[-1]) + 1 if len(gaps) else gap.start() if gap else len(whole)
            part = whole[at:to]
            if len(part) > self.window:
                ends = np.array([0]), np.array([len(part)])
                start, row = ends[0], self._numbered(part, *ends, np.array([self._long(part)], np.uint64))
            else:
                start, row = self._window(part)
            places.append(start + at)
            rows.append(row)
            at = to
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.concatenate(rows), np.searchsorted(np.concatenate(places), ends)


def chunks(texts: Sequence[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``size`` bytes together, each with the place of the first."""
    at = 0
    while at < len(texts):
        first, n, found = at, 0, []
        while at < len(texts) and (at == first or n < size):
            found.append(texts[at])
            n += len(found[-1])
            at += 1
        yield first, found


class Texts:
    """An Arrow column of bytes, read one at a time; NULL is empty."""

    def __init__(self, column: pa.Array):
        self.column = column

    def __len__(self) -> int:
        return len(self.column)

    def __getitem__(self, i: int) -> bytes:
        return self.column[i].as_py() or b""


def as_rows(docs: DataFrame, text: str, **named: str) -> DataFrame:
    """Each row of ``docs`` in one struct ``row``, the key of its text as ``key``, and columns
    of it under other names: nothing can clash with what the rows are joined to."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.select("row", text_key(F.col("row")[text]).alias("key"), *[F.col("row")[c].alias(n) for n, c in named.items()])


def back(rows: DataFrame, like: DataFrame, text: str, body: Column | None = None) -> DataFrame:
    """The columns of ``like`` out of ``row``; ``body`` replaces the text, and its code points
    ``n_chars`` where there is such a column."""
    rows = rows if body is None else rows.withColumn("__body", body)
    out = []
    for c in like.columns:
        if body is not None and c == text:
            out.append(F.col("__body").alias(c))
        elif body is not None and c == "n_chars":
            out.append(F.length("__body").cast(like.schema[c].dataType).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    return rows.select(*out)


#: What a join may copy to every executor, measured.
BROADCAST_BYTES = 48 << 20


def decided(rows: DataFrame, decisions: DataFrame, on: Column, how: str, width: Column) -> DataFrame:
    """``rows`` joined with what was decided of them, which must have been written.

    Rows carry whole texts. Where the decisions, measured by their ``width``, are few
    they are copied to the executors and no text is moved; otherwise both sides are
    shuffled. The rows are the same either way."""
    size = decisions.agg(F.sum(width + 48)).first()[0] or 0
    return rows.join(F.broadcast(decisions) if size <= BROADCAST_BYTES else decisions, on, how)
