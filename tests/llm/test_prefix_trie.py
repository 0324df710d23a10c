import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from corpus_data import CLASHING
from pyspark.sql import functions as F

from dimload.llm import prefix_trie, running
from dimload.llm.prefix_trie import branched, narrow, trie
from dimload.llm.running import running_digest, running_sum

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def many_tasks(spark):
    """Small ranges stay apart, so that keys run over several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def conversations(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in found.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def nodes(convs):
    members, children, out = defaultdict(list), defaultdict(list), []
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [sums[c] for c in children[node]]
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(of), len(node), parent, len(of), len(children[node]), *sums[node], sha))
    return sorted(out, key=repr)


def made(seed=5):
    """Shared beginnings, copies, proper prefixes, ties, repeated rows, NULLs, one long conversation."""
    rnd, rows = random.Random(seed), []
    starts = [[("user", rnd.choice(["hi", "hello", "é"])) for _ in range(rnd.randint(1, 9))] for _ in range(4)]
    for c in range(80):
        if c % 7:
            said = (starts[c % 4] + [("assistant", rnd.choice("ab"))] * rnd.randint(0, 3))[: rnd.randint(1, 12)]
            rows += [(c, k, r, t) for k, (r, t) in enumerate(said)]
    rows += [(200, 0, None, None), (200, None, "user", "before"), (200, 1, "user", None), (200, 1, "user", None), (200, 1, "a", "tie")]
    rows += [(None, 0, "user", "no conversation"), (204, 0, "user", "x" * 100_000)]
    rows += [(300 + k, 0, "user", "copy") for k in range(0, 3000, 5)]
    rows += [(5000, 7, "user", "same")] * 500 + [(5001, k, "user", f"turn {k}") for k in range(400)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("turned", [rebuilt, lambda convs: convs])
def test_against_brute_force(spark, monkeypatch, turned):
    monkeypatch.setattr(prefix_trie, "IDS", 64)
    rows = made()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit("extra").alias(c) for c in CLASHING if c != "row"])
    if turned is rebuilt:
        got = trie(*branched(narrow(frame)), ["part", "place"])
    else:
        got = prefix_trie.prefix_trie(frame)
    want = nodes(turned(conversations(rows)))
    assert sorted((tuple(r) for r in got.drop("node").collect()), key=repr) == want


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(none).count() == 0
    assert trie(*branched(narrow(none)), ["part", "place"]).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert prefix_trie.prefix_trie(lost).count() == 0


def test_one_key_over_many_tasks(spark):
    rows = [(1, k, k % 10) for k in range(5000)] + [(k, 0, k) for k in range(2, 30)] + [(None, 3, 1), (None, 4, 2)]
    frame = spark.createDataFrame(rows, "k long, o long, v long").repartition(4)
    got = running_sum(frame, "k", [F.col("o")], "v", ("place", "before", "after"))
    assert got.rdd.getNumPartitions() > 2
    spread = got.where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 2
    want, state = [], {}
    for k, o, v in sorted(rows, key=lambda r: (r[0] or 0, r[1])):
        n, s = state.get(k, (0, 0))
        state[k] = n + 1, s + v
        want.append((k, o, v, n + 1, s, s + v))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_digests_are_those_of_sequences(spark):
    said = [bytes([k % 3]) * 16 for k in range(600)]
    rows = [(c, k, bytearray(s)) for c in (1, 2) for k, s in enumerate(said)]
    got = running_digest(spark.createDataFrame(rows, "k long, o long, v binary"), "k", [F.col("o")], "v", ("place", "before", "after"))
    by = {(r["k"], r["place"]): (bytes(r["before"]), bytes(r["after"])) for r in got.collect()}
    digest = 0
    for place, s in enumerate(said, 1):
        before, digest = digest, (digest * running.STEP + int.from_bytes(s, "big") + 1) % running.PRIME
        assert by[1, place] == by[2, place] == (before.to_bytes(16, "big"), digest.to_bytes(16, "big"))
    assert len({a for _, a in by.values()}) == len(said)
