"""Words of a corpus that are spelling variants of more frequent ones."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import Texts, decided, utf8
from dimload.sources.scratch import cut_lineage

#: ``[a-zÀ-ÿ]+`` in UTF-8 bytes: these code points are C3 and one byte more.
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_GAP = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")

#: Bytes of a text read at a time; distinct words counted in a task before they are passed on.
PIECE, COUNTED = 1 << 18, 200_000

#: Every how many occurrences one loses a letter.
TYPO_EVERY = 199

#: Words of an index of bitsets, at most, and bytes of the bitsets worked on at a time.
BLOCK, WORKING = 8192, 1 << 22


def _count(least_length: int, typo_every: int | None):
    """Counts of words over the texts of a task, in parts."""

    def altered(run: bytes, h: int) -> bytes:
        letters = run.decode()
        at = h % len(letters)
        return (letters[:at] + letters[at + 1 :]).encode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush():
            kept = [(w, n) for w, n in found.items() if len(w) >= least_length and len(w.decode()) >= least_length]
            found.clear()
            words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            ids, texts = batch.column(0), Texts(batch.column(1))
            for i in range(len(texts)):
                text, at = texts[i], 0
                seed = zlib.crc32((ids[i].as_py() or "").encode() + b":")
                while at < len(text):
                    gap = _GAP.search(text, at + PIECE) if at + PIECE < len(text) else None
                    to = gap.end() if gap else len(text)
                    # One crc32 per distinct run: all its occurrences in a document have the same.
                    for run, n in Counter(_RUN.findall(text[at:to].lower())).items():
                        h = zlib.crc32(run, seed) if typo_every else 1
                        found[run if not typo_every or h % typo_every else altered(run, h)] += n
                    at = to
                if len(found) > COUNTED:
                    yield flush()
        yield flush()

    return count


def vocabulary(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    typo_every: int | None = TYPO_EVERY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(word, n)`` of words with ``least_length`` letters and ``least_count`` occurrences.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF; only A-Z become lower case.
    With ``typo_every`` the occurrences in a document whose crc32 of ``<doc_id>:<word>`` it
    divides lose the letter at place crc32 modulo length. Texts are read whole; counts are added up
    in each task before they are shuffled. NULL texts have no words, a NULL id is empty."""
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), utf8(text).alias("text"))
    counts = rows.mapInArrow(_count(least_length, typo_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class PositionIndex:
    """Bitsets over a list of words: which have a given letter at a given place, and which
    have a given length. A bitset is a row of 64-bit numbers, a bit a word."""

    def __init__(self, words: list[str]):
        self.words, self.width = words, -(-len(words) // 64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.alphabet = np.unique(points)
        word = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        letter = np.searchsorted(self.alphabet, points)
        self.longest = int(length.max(initial=0))
        # A last letter that no word has, and two places after the longest word, stay empty.
        self.at = np.zeros((self.longest + 2, len(self.alphabet) + 1, self.width), np.uint64)
        bit = np.uint64(1) << (word % 64).astype(np.uint64)
        np.bitwise_or.at(self.at, (place, letter, word // 64), bit)
        self.of_length = np.zeros((self.longest + 3, self.width), np.uint64)
        k = np.arange(len(words))
        np.bitwise_or.at(self.of_length, (length, k // 64), np.uint64(1) << (k % 64).astype(np.uint64))

    def _letters(self, words: list[str], longest: int) -> np.ndarray:
        """Letters by place and word as numbers; the number of the missing letter beyond words."""
        none = len(self.alphabet)
        out = np.full((longest, len(words)), none, np.int64)
        for q, word in enumerate(words):
            points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            letter = np.minimum(np.searchsorted(self.alphabet, points), none - 1)
            out[: len(word), q] = np.where(self.alphabet[letter] == points, letter, none)
        return out

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ``(query, word)`` that differ by one inserted, deleted or replaced letter.

        After ``i`` letters of the queries four sets are known per query, a bit a word:
        ``same``, the words that begin with them; ``other``, with one of them replaced;
        ``more``, with one letter more among them; ``less``, with one of them left out.
        The next letter is looked for at place ``i``, one further in ``more`` and one
        before in ``less``, for 64 words at a time and all queries at once."""
        order = sorted(range(len(queries)), key=lambda q: -len(queries[q]))
        queries = [queries[q] for q in order]
        length = np.fromiter(map(len, queries), np.int64, len(queries))
        # Longer queries than any word and one letter can't be near.
        skip = int((length > self.longest + 1).sum())
        found = []
        step = max(1, WORKING // (8 * max(1, self.width)))
        for low in range(skip, len(queries), step):
            some, sizes = queries[low : low + step], length[low : low + step]
            letters = self._letters(some, int(sizes[0]))
            same = np.full((len(some), self.width), ~np.uint64(0))
            other, more, less = np.zeros_like(same), np.zeros_like(same), np.zeros_like(same)
            more[:] = same  # one letter more before the first
            hits = np.zeros_like(same)
            for i in range(int(sizes[0])):
                here = letters[i]
                before = same
                same = before & self.at[i][here]
                other = (other & self.at[i][here]) | before
                less = (less & self.at[i - 1][here]) | before if i else before.copy()
                more = (more & self.at[i + 1][here]) | same
                done = int((sizes > i + 1).sum())
                if done < len(some):
                    n = i + 1
                    hits[done : len(some)] = (
                        ((other[done:] & ~same[done:]) & self.of_length[n])
                        | (more[done:] & self.of_length[n + 1])
                        | (less[done:] & self.of_length[n - 1])
                    )
                    some = some[:done]
                    same, other, more, less, letters = same[:done], other[:done], more[:done], less[:done], letters[:, :done]
            row, column = np.nonzero(hits)
            bits = np.unpackbits(hits[row, column].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, bit = np.nonzero(bits)
            found.append((low + row[k], column[k] * 64 + bit))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, word = (np.concatenate(x) for x in zip(*found))
        return np.array(order, np.int64)[query], word


def _in_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of a sorted task: whole units of it, together as large as a block, share an index.

    A pair is passed on by one unit of all that hold it: that of the shorter word's length,
    and of the first letters if both words begin with these."""
    rows: list[tuple[str, str, int, bool, bool]] = []

    def flush() -> pa.RecordBatch:
        asks, index = [r for r in rows if r[3]], [r for r in rows if r[4]]
        number = {u: k for k, u in enumerate(dict.fromkeys(r[0] for r in rows))}
        of_query, of_word = (np.array([number[r[0]] for r in x], np.int64) for x in (asks, index))
        query, word = PositionIndex([r[1] for r in index]).near([r[1] for r in asks]) if index and asks else ([], [])
        out = []
        if len(query):
            together = of_query[query] == of_word[word]
            for q, w in zip(query[together].tolist(), word[together].tolist()):
                (unit, a, *_), b, n = asks[q], index[w][1], index[w][2]
                shorter = min(len(a), len(b))
                k = shorter // 2
                if shorter == int(unit[1 : unit.index(":")]) and (unit[0] == "p" or a[:k] != b[:k]):
                    out.append((a, b, n))
        rows.clear()
        a, b, n = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["word", "near", "n"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("unit", "word", "n", "asks", "index"))):
            if len(rows) >= BLOCK and row[0] != rows[-1][0]:
                yield flush()
            rows.append(row)
    if rows:
        yield flush()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """All ``(word, near, n)``, both ways round, of distinct words (columns ``word, n``) that
    differ by exactly one inserted, deleted or replaced letter; ``n`` is that of ``near``.

    One error leaves the first or the last half of the shorter word's letters as they are,
    so words meet in cells of an equal half: for each length ``l`` of the shorter word those of
    ``l`` and ``l + 1`` letters, by their first and by their last ``l // 2``. Cells are searched
    by ``PositionIndex``. One with more than ``block`` words is cut into tiles,
    each of some words to look for and some to look in; no pair is lost."""
    rows = None
    for shorter in (F.length("word") - 1, F.length("word")):
        half = F.floor(shorter / 2).cast("int")
        for side, letters in (("p", F.substring("word", F.lit(1), half)), ("s", F.when(half > 0, F.right("word", half)).otherwise(""))):
            one = words.where(shorter > 0).select(F.concat(F.lit(side), shorter.cast("string"), F.lit(":"), letters).alias("cell"), "word", "n")
            rows = one if rows is None else rows.unionAll(one)
    sizes = rows.groupBy("cell").agg(F.count("*").alias("size"))
    large = cut_lineage(sizes.where(F.col("size") > block).select("cell", F.ceil(2 * F.col("size") / block).cast("int").alias("tiles")))
    known = F.col("cell") == F.col("__cell")
    rows = decided(rows, large.withColumnRenamed("cell", "__cell"), known, "left", F.octet_length("__cell"))
    tiles = F.coalesce("tiles", F.lit(1))
    own, every = F.pmod(F.xxhash64("word"), tiles).cast("int"), F.sequence(F.lit(0), tiles - 1)

    def placed(asks: bool, index: bool, i, j):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"), F.lit(index).alias("index"))

    cut = F.concat(
        F.transform(every, lambda t: placed(True, False, t, own)),
        F.transform(every, lambda t: placed(False, True, own, t)),
    )
    whole = F.array(placed(True, True, F.lit(0), F.lit(0)))
    rows = rows.select("cell", "word", "n", F.explode(F.when(tiles > 1, cut).otherwise(whole)).alias("t"))
    unit = F.concat("cell", F.lit("|"), F.col("t.i").cast("string"), F.lit("|"), F.col("t.j").cast("string"))
    rows = rows.select(unit.alias("unit"), "word", "n", "t.asks", "t.index")
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(tasks, words.count() // 50_000), "unit").sortWithinPartitions("unit")
    return rows.mapInArrow(_in_units, "word string, near string, n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: the last of the forms reached from it.

    ``forms`` (``word, form``) must not run in a circle. Every round doubles the steps
    taken, so chains of 2^k words take k rounds."""
    found = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("__word"), F.col("root").alias("further"))
        step = decided(found, further, F.col("root") == F.col("__word"), "left", F.octet_length("__word") + F.octet_length("further"))
        step = cut_lineage(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        found = step.select("word", "root")
        if step.where("moved").isEmpty():
            return found


def spelling_variants(words: DataFrame, times: int = 5, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words (columns ``word, n``).

    Near words differ by exactly one inserted, deleted or replaced letter. ``form`` is the near
    word with the largest ``n`` (of several, the first in code-point order), if that is at least
    ``times`` the word's, and ``form_n`` its ``n``; otherwise both are NULL. ``root`` is the
    last word reached by forms, the word itself if it has none. ``n_near`` counts the near
    words. ``times`` must be at least 2, so forms never run in a circle. No words: no rows."""
    if times < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = cut_lineage(words.select("word", "n"))
    near = near_words(words, block).groupBy("word")
    best = near.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("near"))).alias("best"))
    best = best.withColumnRenamed("word", "__word")
    rows = words.join(best, F.col("word") == F.col("__word"), "left")
    much = -F.col("best.m") >= times * F.col("n")
    rows = cut_lineage(
        rows.select(
            "word",
            F.when(much, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(much, -F.col("best.m")).alias("form_n"),
        )
    )
    last = roots(rows.where("form IS NOT NULL")).withColumnRenamed("word", "__word")
    rows = decided(rows, last, F.col("word") == F.col("__word"), "left", F.octet_length("__word") + F.octet_length("root"))
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
