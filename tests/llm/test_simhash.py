import random

import pytest
import xxhash
from pyspark.sql import functions as F

from dimload.llm import simhash


def plain_fingerprint(text, k=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                group[root(a)] = root(b)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("text", ["", " \n", None, "One", "one TWO", "ÉA b C d", "a b a b a b a b", "w " * 700, "z" * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_components_by_brute_force(rows, odd_docs):
    found = simhash.simhash_components(odd_docs).collect()
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted(
        (str(row[0]), f"{p:016x}") for row, p in zip(rows, prints)
    )
    group = plain_components(set(prints))
    least = {}
    for row, p in zip(rows, prints):
        if row[0] is not None:
            least[group[p]] = min(row[0], least.get(group[p], row[0]))
    assert {(r.fingerprint, r.component_id) for r in found} == {(f"{p:016x}", least.get(group[p])) for p in prints}
    # One content of each component is marked.
    marked = {(r.component_id, r.text_key) for r in found if r.kept}
    assert len(marked) == len(set(group.values()))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("largest", [2, 8, 10_000])
def test_links_of_crowded_buckets(spark, largest):
    """Small buckets, buckets cut once, and buckets cut to the last level find the same."""
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    prints = {centre, 0, (1 << 64) - 1, 3, 1 << 63}
    for _ in range(150):  # one half as the centre, few bits of the other
        p = centre
        for _ in range(rnd.randint(1, 4)):
            p ^= 1 << (rnd.randrange(32) if rnd.random() < 0.8 else rnd.randrange(64))
        prints.add(p)
    want = {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 2}
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = simhash.fingerprint_links(df, 2, largest).collect()
    assert len(want) > 100 and sorted(map(tuple, got)) == sorted(want)


def test_one_of_each(odd_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r.text for r in kept.collect()]
    assert len({plain_fingerprint(t) for t in texts}) == len(texts)
    assert kept.where("doc_id between 100 and 105").count() <= 1
    assert kept.where(F.col("doc_id") == 204).count() == 1


def test_no_rows(no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).columns == no_docs.columns


def test_bits_that_the_index_cannot_find(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.range(1).withColumnRenamed("id", "fp"), 3)


def test_fingerprints_are_dealt_before_they_are_indexed(spark, monkeypatch):
    """Also where they lie by fingerprint already, and in more tasks where there are many."""
    plans, written = [], simhash.cut_lineage
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(simhash, "cut_lineage", lambda df: (plans.append(text(df)), written(df))[1])
    monkeypatch.setattr(simhash, "FAN_OUT", 10)
    distinct = spark.range(400).select(F.xxhash64("id").alias("fp")).groupBy("fp").agg(F.count("*").alias("n"))
    simhash.fingerprint_links(distinct, 2)
    below = plans[0][plans[0].index("Generate explode") :]
    assert "REPARTITION_BY_NUM" in below and ", 40)" in below.split("REPARTITION_BY_NUM")[0]
