from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimload.llm import mixing


def plain_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        level = (total - sum(most * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in rest))
        over = {s for s in rest if most * sizes[s] <= level * weight[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_targets(spark):
    sizes = {"b": 10, "a": 100_000, "\U0001f600": 3, "￿": 50_000, None: 7, "zero": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r for r in mixing.source_targets(rows).collect()}
    want = plain_targets(sizes)
    for s, t in want.items():
        assert found[s].target == pytest.approx(t) and abs(found[s].quota - t) <= 0.5
        assert found[s].target <= 3 * sizes[s]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(spark, n):
    df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(12345).cast("long")).alias("p"))
    got = [r.p for r in df.collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        assert got != sorted(got) and abs(np.corrcoef(range(n), got)[0, 1]) < 0.1


@pytest.mark.parametrize("block, shard", [(16, 8), (256, 256), (1, 1000)])
def test_mix(odd_docs, rows, block, shard):
    everything = mixing.mix(odd_docs, block=block, shard=shard)
    found = mixing.words_taken(*everything).collect()
    size = lambda t: len((t or "").encode().split())
    assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in found) == sorted((str(i), str(s), size(t)) for i, t, _, s, _ in rows)
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    want, taken = plain_targets(sizes), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    # Within a pass no word is taken twice; no shard has too many slots.
    seen, slots = set(), defaultdict(set)
    for s in everything[2].collect():
        slots[s.shard].add((s.sid, s.slot))
        for w in range(s.word_from, s.word_to):
            assert (s.sid, s["pass"], s.start, w) not in seen
            seen.add((s.sid, s["pass"], s.start, w))
    assert max(map(len, slots.values())) <= shard


def test_reruns_agree(odd_docs):
    one, two = (mixing.mix(df, block=16, shard=8) for df in (odd_docs, odd_docs.repartition(5, "text")))
    for a, b in zip(one, two):
        assert sorted(map(str, a.drop("chunk").collect())) == sorted(map(str, b.drop("chunk").collect()))


def test_mixed_documents(odd_docs, rows):
    mixed = mixing.mixed_documents(odd_docs, block=16, shard=8)
    assert mixed.columns == odd_docs.columns
    found = mixed.collect()
    texts = defaultdict(set)
    for i, t, *_ in rows:
        texts[str(i)].add(t)
    total = 0
    for r in found:
        total += len(r.text.split())
        assert r.n_chars == len(r.text)
        words = [t.encode().split() for t in texts[str(r.doc_id)] if t]
        assert any(set(r.text.encode().split()) <= set(w) for w in words)
    _, sources, _ = mixing.mix(odd_docs, block=16, shard=8)
    # str.split knows more white space than a word's end; these texts have none of it.
    assert total == sources.agg(F.sum("quota")).first()[0]


def test_no_rows(no_docs, spark):
    assert mixing.words_taken(*mixing.mix(no_docs)).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.words_taken(*mixing.mix(empty)).collect()] == [(0, 0.0)] * 2


def test_no_python(odd_docs):
    for df in (mixing.words_taken(*mixing.mix(odd_docs)), mixing.mixed_documents(odd_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
