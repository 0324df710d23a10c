"""Passages of benchmark items inside documents, and documents without them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import Texts, back, decided, utf8
from dimload.sources.scratch import cut_lineage

#: A word: ASCII letters and digits, and every byte of code points beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

#: Words of items that are broadcast and searched for at once; more are searched for in turns.
MOST_WORDS = 2_000_000

#: Bytes of a text split into words at a time, and words whose windows are hashed at a time.
PIECE, STRETCH = 1 << 18, 1 << 18

_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPANS)])
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first: int, last: int>>"


def pieces(text: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    """The text in parts of about ``size`` bytes that cut no word, each with its place."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + size) if at + size < len(text) else None
        to = gap.end() if gap else len(text)
        yield at, text[at:to]
        at = to


def normalised(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return [w for _, part in pieces(text, PIECE) for w in _WORD.findall(part.lower())]


def _hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` consecutive words."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k : len(words) - n + 1 + k].astype(np.uint64)
        out ^= out >> np.uint64(29)
    return out


def _differ(flat: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether the words from places ``a`` on differ from those from ``b`` on, word by word."""
    out = np.zeros(len(a), bool)
    for k in range(size):
        out |= flat[a + k] != other[b + k]
    return out


def windows(items: list[tuple[str, bytes]], n: int) -> dict:
    """The distinct windows of some items, as plain arrays to broadcast.

    A window is ``n`` consecutive words of an item, or all words of a shorter one. Words are
    numbers from 1, their places among the sorted ``words`` of the items; ``flat`` holds the items in
    such numbers. Per length of window ``tables`` holds the sorted hashes; the first window of
    each hash; where in ``flat`` each window stands; its first item; the items."""
    texts = [normalised(text) for _, text in items]
    words = sorted({w for t in texts for w in t})
    number = {w: k + 1 for k, w in enumerate(words)}
    rows = [np.fromiter(map(number.get, t), np.int32, len(t)) for t in texts]
    flat = np.concatenate([np.zeros(0, np.int32), *rows])
    found, at = {}, 0
    for k, row in enumerate(rows):
        size = min(n, len(row))
        if size:
            hashes = _hashes(row, size)
            found.setdefault(size, []).append((hashes, at + np.arange(len(hashes)), np.full(len(hashes), k)))
        at += len(row)
    tables = {}
    for size, parts in found.items():
        hashes, place, item = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(hashes, kind="stable")
        hashes, place, item = hashes[order], place[order], item[order]
        # Equal windows are one, with all their items; different ones of one hash stay apart.
        new = np.append(True, (hashes[1:] != hashes[:-1]) | _differ(flat, place[1:], flat, place[:-1], size))
        first_item = np.append(np.flatnonzero(new), len(item))
        known, first = np.unique(hashes[new], return_index=True)
        tables[size] = known, np.append(first, int(new.sum())), place[new], first_item, item
    return {"words": b" ".join(words), "items": [i for i, _ in items], "flat": flat, "tables": tables}


def search(shared: dict, row: np.ndarray) -> tuple[np.ndarray, set[int]]:
    """``(hit, items)`` of a document in numbers of words (0: in no item): whether each word
    stands in a window, and which items have such windows."""
    edge, met = np.zeros(len(row) + 1, np.int32), set()
    for size, (known, first, place, first_item, item) in shared["tables"].items():
        for at in range(0, max(0, len(row) - size + 1), STRETCH):
            part = row[at : at + STRETCH + size - 1]
            hashes = _hashes(part, size)
            where = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.flatnonzero(known[where] == hashes)
            turn, last = first[where[hit]], first[where[hit] + 1]
            while len(hit):  # once, but for different windows of one hash
                same = ~_differ(part, hit, shared["flat"], place[turn], size)
                for window in np.unique(turn[same]).tolist():
                    met.update(item[first_item[window] : first_item[window + 1]].tolist())
                edge[at + hit[same]] += 1
                edge[at + hit[same] + size] -= 1
                left = turn + 1 < last
                hit, turn, last = hit[left], turn[left] + 1, last[left]
    return np.cumsum(edge[:-1]) > 0, met


def stretches(hit: np.ndarray) -> list[dict]:
    """First and last place of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"first": a, "last": b} for a, b in zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())]


def _scanner(broadcast):
    """A column function from the bytes of a text to ``FOUND``, by broadcast windows."""

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        shared = broadcast.value
        if "numbers" not in shared:
            shared["numbers"] = {w: k + 1 for k, w in enumerate(shared["words"].split())}
        number, out = shared["numbers"].get, []
        texts = Texts(texts)
        for i in range(len(texts)):
            parts = [np.zeros(0, np.int32)]
            for _, part in pieces(texts[i], PIECE):
                words = _WORD.findall(part.lower())
                parts.append(np.fromiter(map(number, words, repeat(0)), np.int32, len(words)))
            row = np.concatenate(parts)
            hit, met = search(shared, row)
            items = sorted({shared["items"][k] for k in met})
            out.append({"n_words": len(row), "n_hit": int(hit.sum()), "items": items, "spans": stretches(hit)})
        return pa.array(out, _FOUND)

    return scan


def _united(n_words: pa.Array, passes: pa.Array) -> pa.Array:
    """What several passes found in one text, as one."""
    out = []
    for n, found in zip(n_words.to_pylist(), passes.to_pylist()):
        hit = np.zeros(n, bool)
        for one in found:
            for span in one["spans"]:
                hit[span["first"] : span["last"] + 1] = True
        items = sorted({i for one in found for i in one["items"]})
        out.append({"n_words": n, "n_hit": int(hit.sum()), "items": items, "spans": stretches(hit)})
    return pa.array(out, _FOUND)


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without these stretches of words: from the first letter of a stretch to its last."""
    out = []
    for text, cut in zip(texts, spans.to_pylist()):
        text = text.as_py()
        if text is None or not cut:
            out.append(text)
            continue
        kept, at, place, cut = [], 0, 0, iter(cut)
        span = next(cut)
        for begin, part in pieces(text, PIECE):
            for word in _WORD.finditer(part.lower()):
                if span and place == span["first"]:
                    kept.append(text[at : begin + word.start()])
                if span and place == span["last"]:
                    at, span = begin + word.end(), next(cut, None)
                place += 1
        out.append(b"".join([*kept, text[at:]]))
    return pa.array(out, pa.binary())


def _dealt(benchmark: DataFrame, text: str, item: str, n: int, most_words: int) -> tuple[DataFrame, int]:
    """``item, body, part``: items dealt by a hash into parts of at most about ``most_words``
    words, and the number of parts. Long items come in pieces that share ``n - 1`` words, so
    no window is lost."""
    size = max(2 * n, most_words // 8)

    @F.arrow_udf("array<struct<body: binary, words: int>>")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            words = normalised(text.as_py() or b"")
            starts = range(0, max(1, len(words) - n + 1), size - n + 1)
            parts = [words[s : s + size] for s in starts]
            out.append([{"body": b" ".join(p), "words": len(p)} for p in parts if p])
        return pa.array(out, pa.list_(pa.struct([("body", pa.binary()), ("words", pa.int32())])))

    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.explode(cut(utf8(text))).alias("p"))
    items = cut_lineage(items.select("item", "p.body", "p.words").distinct())
    total = items.agg(F.sum("words")).first()[0] or 0
    # Parts are not equal: half of the bound is dealt, so that a part hardly goes beyond it.
    parts = 1 if total <= most_words else -(-2 * total // most_words)
    return items.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(parts)).cast("int")), parts


def _found(rows: DataFrame, body: Column, benchmark: DataFrame, item_text: str, item: str, n: int, most_words: int) -> DataFrame:
    """``rows`` (a column ``row``) with ``found`` of the text ``body``."""
    items, parts = _dealt(benchmark, item_text, item, n, most_words)
    scans = []
    for part in range(parts):
        some = items.where(F.col("part") == part).select("item", "body").collect()
        shared = windows(sorted((r["item"], bytes(r["body"])) for r in some), n)
        scans.append(_scanner(rows.sparkSession.sparkContext.broadcast(shared)))
    if parts == 1:
        return rows.select("row", scans[0](body).alias("found"))
    key, passes = F.md5(F.coalesce(body, F.lit(b""))), None
    for scan in scans[1:]:
        one = rows.select(key.alias("of"), scan(body).alias("found")).where("found.n_hit > 0").dropDuplicates(["of"])
        one = cut_lineage(one)
        passes = one if passes is None else passes.unionAll(one)
    others = cut_lineage(passes.groupBy("of").agg(F.collect_list("found").alias("others")))
    rows = rows.select("row", key.alias("key"), scans[0](body).alias("found"))
    width = F.aggregate("others", F.lit(0), lambda n, f: n + 8 * F.size(f["spans"]) + 24 * F.size(f["items"]))
    rows = decided(rows, others, F.col("key") == F.col("of"), "left", width)
    every = F.array_append(F.coalesce("others", F.array().cast(f"array<struct<{FOUND}>>")), F.col("found"))
    return rows.select("row", F.arrow_udf(_united, FOUND)("found.n_words", every).alias("found"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "contamination",
    text: str = "text",
    item_text: str = "text",
    item: str = "item_id",
    n: int = 10,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``docs`` with a struct ``name`` of what they share with the items of ``benchmark``:
    ``n_words``; ``n_hit``, the words inside passages of items; ``items``, the sorted ids, as
    strings, of the items with such passages; ``spans``, the stretches of hit words by
    their places among the words.

    Words are runs of ASCII letters and digits and of all code points beyond ASCII, with
    A-Z in lower case. A passage is a window of ``n`` consecutive words of an item, or all
    of an item with fewer words. Windows of documents are looked up by hash and
    verified word by word. Texts are read whole, in pieces.

    Broadcast are the windows of about ``most_words`` words of items at most. A larger
    benchmark is searched for in several passes over the texts, each for other items; what the
    passes found, a row a text, is joined by the MD5 of the text.

    A NULL or wordless text has no words and no hits, a wordless item no windows; a NULL id
    of an item is the id ``''``; rows of one id are one item; repeated documents stay, each with
    its result; no items, no hits; no rows, no rows. A column called ``name`` is replaced."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = _found(rows, utf8(F.col("row")[text]), benchmark, item_text, item, n, most_words)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != name], F.col("found").alias(name))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float = 0.5,
    text: str = "text",
    item_text: str = "text",
    item: str = "item_id",
    n: int = 10,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``docs`` without passages of ``benchmark`` (see ``contamination``).

    A document more than ``drop_share`` of whose words are hit is left out whole (0: any
    with a hit; 1: none). From others the stretches of hit words are cut, from the first
    letter of a stretch to its last; all else, and texts without hits, stay as they are.
    ``n_chars``, where there is such a column, follows. NULL texts stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = utf8(F.col("row")[text])
    found = _found(rows, body, benchmark, item_text, item, n, most_words)
    found = found.where(F.col("found.n_hit") <= F.lit(float(drop_share)) * F.col("found.n_words"))
    cut = F.arrow_udf(_without, "binary")(F.when(F.col("found.n_hit") > 0, body), F.col("found.spans")).cast("string")
    return back(found, docs, text, F.when(F.col("found.n_hit") > 0, cut).otherwise(F.col("row")[text]))
