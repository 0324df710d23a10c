import re

import pytest
from corpus_data import CLASHING, SCHEMA, prose
from pyspark.sql import functions as F

from dimload.llm import decontamination
from dimload.llm.decontamination import contamination, decontaminate, normalised, pieces, search, windows

LONG = prose(1, 60).replace(".\n", " ").split()
LATE = prose(2, 30).replace(".\n", " ").split()
ITEMS = [
    (1, " ".join(LONG)),
    (2, " ".join(LATE).upper()),
    (3, "Tiny-item, five words: ÉTÉ été"),
    (3, " ".join(LATE[5:25]) + " end"),
    (10, " ".join(LONG[10:22])),
    (None, "no id here at all"),
    (4, ""),
    (5, None),
    (6, "!!! ???"),
    (7, "one"),
]
DOCS = [
    (1, "before " + " ".join(LONG[3:18]) + " after"),
    (2, "nothing of it, ten words that no item has in it"),
    (3, "He said: tiny item FIVE words ÉTÉ été. And " + " ".join(LATE[4:15]) + ", you see"),
    (3, "He said: tiny item FIVE words ÉTÉ été. And " + " ".join(LATE[4:15]) + ", you see"),
    (4, " ".join(LONG)),
    (5, " ".join(LONG[:9])),
    (6, None),
    (7, ""),
    (8, " .. "),
    (9, "x " * 5000 + " ".join(LONG[:20]) + " y" * 5000),
    (10, "No ID, here; at-all"),
    (11, "mid one mid"),
    (None, " ".join(LATE)),
    (12, "tiny item five words été ÉTÉ"),
]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(doc, n=10):
    w, hit, met = words(doc), set(), set()
    for item, text in ITEMS:
        i = words(text)
        size = min(n, len(i))
        known = {tuple(i[k : k + size]) for k in range(len(i) - size + 1)} if size else set()
        for k in range(len(w) - size + 1):
            if size and tuple(w[k : k + size]) in known:
                hit |= set(range(k, k + size))
                met.add("" if item is None else str(item))
    return len(w), sorted(hit), sorted(met)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "en", "a", None if t is None else len(t)) for i, t in DOCS], SCHEMA)
    docs = docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("most_words", [decontamination.MOST_WORDS, 40])
def test_against_brute_force(tables, most_words):
    docs, items = tables
    found = contamination(docs, items, "found", most_words=most_words)
    assert found.columns == [*docs.columns, "found"]
    got = []
    for r in found.collect():
        hit = [k for s in r["found"]["spans"] for k in range(s["first"], s["last"] + 1)]
        assert r["found"]["n_hit"] == len(hit) and r["row"] == "extra row"
        got.append((r["text"] or "", r["found"]["n_words"], hit, r["found"]["items"]))
    assert sorted(got) == sorted((t or "", *brute(t)) for _, t in DOCS)


def test_spans_are_cut(tables):
    docs, items = tables
    out = decontaminate(docs, items, drop_share=0.9)
    assert out.schema == docs.schema
    kept = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    cut = "before  after"
    assert (1, cut, len(cut)) in kept
    cut = "He said: . And , you see"
    assert (3, cut, len(cut)) in kept and sum(i == 3 for i, *_ in kept) == 1 and out.where("doc_id = 3").count() == 2
    assert {i for i, *_ in kept} == {1, 2, 3, 5, 6, 7, 8, 9, 11, 12}  # whole items go: 4, 10, the one without an id
    assert (6, None, None) in kept and (7, "", 0) in kept
    long = next(t for i, t, _ in kept if i == 9)
    assert long == "x " * 5000 + " y" * 5000
    assert contamination(out, items).where("contamination.n_hit > 0").count() == 0
    assert {r["doc_id"] for r in decontaminate(docs, items, drop_share=0).collect()} == {2, 5, 6, 7, 8, 12}


def test_empty(tables, spark, no_docs):
    docs, items = tables
    assert contamination(no_docs, items).count() == 0 and decontaminate(no_docs, items).count() == 0
    none = items.where("false")
    assert contamination(docs, none).where("contamination.n_hit > 0").count() == 0
    assert decontaminate(docs, none, drop_share=0).count() == len(DOCS)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontamination, "_hashes", lambda w, n: (w[: max(0, len(w) - n + 1)] * 0).astype("uint64"))
    shared = windows([("a", b"p q r"), ("b", b"q r s"), ("c", b"p q r")], 3)
    number = {w: k + 1 for k, w in enumerate(shared["words"].split())}
    for text, want, met in (("p q r", 3, {0, 2}), ("x q r s", 3, {1}), ("p q s", 0, set()), ("p q r s", 4, {0, 1, 2})):
        row = decontamination.np.array([number.get(w.encode(), 0) for w in text.split()], "int32")
        hit, items = search(shared, row)
        assert (hit.sum(), items) == (want, met)


def test_pieces_cut_no_word(monkeypatch):
    text = ("wörd " * 50 + "x" * 500 + " end").encode()
    for size in (1, 7, 64, 10_000):
        parts = list(pieces(text, size))
        assert b"".join(p for _, p in parts) == text and all(text[a : a + len(p)] == p for a, p in parts)
        monkeypatch.setattr(decontamination, "PIECE", size)
        assert [w.decode() for w in normalised(text)] == words(text.decode())
