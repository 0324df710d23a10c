import random
import re
import zlib
from collections import Counter

import pytest
from corpus_data import CLASHING, SCHEMA
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimload.llm import spelling
from dimload.llm.spelling import PositionIndex, near_words, roots, spelling_variants, vocabulary


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


WORDS = st.lists(st.text(alphabet="abé", min_size=1, max_size=6), unique=True, max_size=80)


@given(WORDS, st.lists(st.text(alphabet="abéz", min_size=1, max_size=9), max_size=30))
def test_position_index(words, queries):
    queries = queries + words
    if words:
        q, w = PositionIndex(words).near(queries)
        assert sorted(zip(q.tolist(), w.tolist())) == sorted(
            (i, j) for i, a in enumerate(queries) for j, b in enumerate(words) if near(a, b)
        )


def made_words(seed=3, n=400):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 9))) for _ in range(n)}
    words |= {w[:i] + "d" + w[i + 1 :] for w in list(words)[:60] for i in range(len(w))}
    words |= {"prefixes" + "".join(rnd.choice("xyz") for _ in range(4)) for _ in range(80)}  # one large cell
    return [(w, rnd.choice([5, 6, 30, 31, 200, 5000])) for w in sorted(words)]


def expected(counted, times=5):
    n = dict(counted)
    close = {a: [b for b in n if near(a, b)] for a in n}
    form = {}
    for a, b in close.items():
        best = min(b, key=lambda w: (-n[w], w), default=None)
        if best is not None and n[best] >= times * n[a]:
            form[a] = best
    out = []
    for a in n:
        root = a
        while root in form:
            root = form[root]
        out.append((a, form.get(a), root, n[a], len(close[a]), n[form[a]] if a in form else None))
    return sorted(out)


@pytest.mark.parametrize("block", [spelling.BLOCK, 16])
def test_variants_against_brute_force(spark, monkeypatch, block):
    counted = made_words()
    words = spark.createDataFrame(counted, "word string, n long")
    if block == 16:
        monkeypatch.setattr(spelling, "BLOCK", 16)
    assert sorted(map(tuple, spelling_variants(words, block=block).collect())) == expected(counted)
    pairs = near_words(words, block).collect()
    assert len(pairs) == len(set(pairs)) == sum(r[4] for r in expected(counted))


def test_roots_of_long_chains(spark):
    chain = [(f"w{k:02}", f"w{k + 1:02}") for k in range(21)] + [("x", "w05")]
    got = dict(map(tuple, roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {a: "w21" for a, _ in chain}


TEXTS = [
    (1, "Naïve naïve NAÏVE coöperate ÀÉ× über-größe"),
    (2, None),
    (3, ""),
    (None, "without id Without"),
    (4, "123 !!! 中文 a"),
    (5, "word " * 400 + "ENDING" * 30_000),
    (6, "again again"),
    (6, "again again"),
] + [(100 + k, " ".join(f"{'abcdefghij'[k % 10]}common{'klmnopqrst'[j % 10]}{'uvwxyzabcd'[j // 10]}" for j in range(60))) for k in range(60)]


def counted_by_hand(every):
    found = Counter()
    for i, text in TEXTS:
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if c.isascii() else c for c in text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


@pytest.mark.parametrize("every, piece", [(199, spelling.PIECE), (7, 64), (None, 1000)])
def test_vocabulary(spark, monkeypatch, every, piece):
    monkeypatch.setattr(spelling, "PIECE", piece)
    monkeypatch.setattr(spelling, "COUNTED", 50)
    docs = spark.createDataFrame([(i, t, "en", "a", None) for i, t in TEXTS], SCHEMA).repartition(3)
    docs = docs.select("*", *[F.lit("extra").alias(c) for c in [*CLASHING, "word", "n"]])
    got = Counter({r["word"]: r["n"] for r in vocabulary(docs, 3, 2, every).collect()})
    assert got == Counter({w: n for w, n in counted_by_hand(every).items() if len(w) >= 3 and n >= 2})


def test_empty(spark, no_docs):
    words = vocabulary(no_docs)
    assert words.count() == 0 and spelling_variants(words).count() == 0
    one = spark.createDataFrame([("alone", 7)], "word string, n long")
    assert [tuple(r) for r in spelling_variants(one).collect()] == [("alone", None, "alone", 7, 0, None)]
    with pytest.raises(ValueError):
        spelling_variants(one, times=1)
