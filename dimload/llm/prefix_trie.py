"""What conversations share from their beginning: a trie of turns with weights."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import decided, utf8
from dimload.llm.running import running_digest, running_sum
from dimload.sources.scratch import cut_lineage

#: The digest of no turns.
ROOT = bytes(16)

#: Ids by which a list of ends is put together.
IDS = 1024


def narrow(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id long, turn, said, bytes``: each turn by the digest of its role and text, and
    the UTF-8 bytes of its text. NULL roles and texts are empty. Rows without an id belong to no conversation."""
    role, text = (F.coalesce(utf8(c), F.lit(b"")) for c in (role, text))
    length = F.octet_length(role).cast("string").cast("binary")
    return turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(length, F.lit(b":"), role, text))).alias("said"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def branched(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the beginnings of others: ``(turns, ids)`` for ``trie``.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % group`` in place of its own
    first ``h``, with ``h`` the crc32 of its decimal id modulo ``most``: all there are, if fewer, and
    none if there is no such conversation. Turns are placed without bringing a
    conversation to one task; a beginning is copied ``group`` times at most."""
    placed = running_sum(turns, "conv_id", [F.col("turn"), F.col("said")], "bytes", ("place", "__a", "__b"))
    placed = cut_lineage(placed.select("conv_id", "place", "said", "bytes"))
    ids = cut_lineage(placed.select("conv_id").distinct())

    def first(c: Column) -> Column:
        return F.crc32(c.cast("string").cast("binary")) % most

    heads = placed.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    others = F.array(*[F.lit(k).cast("long") for k in range(1 - group, group)])
    heads = heads.withColumn("k", F.explode(others)).withColumn("conv_id", F.try_add("base", "k"))
    mine = (F.col("conv_id") - F.col("conv_id") % group == F.col("base")) & (F.col("place") <= first(F.col("conv_id")))
    heads = heads.where(mine).join(ids, "conv_id", "left_semi")
    own = placed.where(F.col("place") > first(F.col("conv_id")))
    columns = ["conv_id", "part", "place", "said", "bytes"]
    rebuilt = heads.withColumn("part", F.lit(0)).select(columns).unionAll(own.withColumn("part", F.lit(1)).select(columns))
    return rebuilt, ids


def _ends(whole: DataFrame) -> DataFrame:
    """``depth, node, ends_sha256`` of the nodes at which conversations end.

    Ids are put together in lists of ``IDS`` at most, by their upper bits; the lists of a node
    are then hashed one after the other, as the digest of one long list requires, of
    which a task holds a batch at a time."""
    part = F.floor(F.col("conv_id") / IDS).cast("long")
    lists = whole.groupBy("depth", "node", part.alias("part")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    lists = lists.select("depth", "node", "part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    tasks = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = lists.repartition(tasks, "depth", "node").sortWithinPartitions("depth", "node", "part")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            found = []
            for d, node, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids"))):
                if at == (d, node):
                    digest.update(b"," + ids.encode())
                else:
                    if at:
                        found.append((*at, digest.hexdigest()))
                    at, digest = (d, node), hashlib.sha256(ids.encode())
            yield packed(found)
        if at:
            yield packed([(*at, digest.hexdigest())])

    def packed(found: list) -> pa.RecordBatch:
        d, node, sha = zip(*found) if found else ((), (), ())
        columns = [pa.array(d, pa.int64()), pa.array(node, pa.binary()), pa.array(sha, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["depth", "node", "ends_sha256"])

    return lists.mapInArrow(hashed, "depth long, node binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per node of the trie of conversations: per distinct sequence of first turns.

    ``turns``: ``conv_id, said, bytes`` and the columns ``order``, which place a
    conversation's turns; ``ids``: all conversations (``conv_id``, each once), also those without turns. Returned are ``depth``
    (0: the root, no turns), ``conv_id`` (the smallest member), ``parent_conv_id`` (that of the
    parent; NULL for the root), ``n_convs`` (members: conversations that begin so),
    ``n_children``, ``n_leaves`` (nodes without children at or below it), ``saved_tokens``
    (summed over the node and all below: ``n_convs - 1`` times the bytes of its last text), ``ends_sha256``
    (SHA-256 of the ids of members that end here, ascending, joined by commas) and ``node``.

    Equal conversations become one sequence with a weight and a list of ends. Sequences
    that are proper prefixes of others go by an anti-join; those left are the leaves. Nodes are the
    prefixes of sequences, with weights added up. Each node is owned by the sequence
    of its smallest member; what a sequence owns is the end of its path, so the sum over
    all nodes below one is that over whatever the sequences through it own, less what its
    owner owns above it: sums per sequence, without pairs of nodes.

    Nodes are known by 127-bit digests of their turns. No conversation, group of equal ones or
    common beginning is brought to one task, but for the one hash over a node's list of ends."""
    placed = running_digest(turns, "conv_id", [F.col(c) for c in order], "said", ("depth", "parent", "node"))
    placed = cut_lineage(placed.select("conv_id", "depth", "parent", "node", "bytes"))
    longest = placed.groupBy("conv_id").agg(F.max(F.struct("depth", "node")).alias("end"))
    whole = ids.join(longest, "conv_id", "left").select(
        "conv_id",
        F.coalesce("end.depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("end.node", F.lit(ROOT)).alias("node"),
    )
    whole = cut_lineage(whole)

    # Sequences with weights; the paths of their smallest conversations stand for all.
    sequences = whole.groupBy("depth", "node").agg(F.min("conv_id").alias("of"), F.count("*").alias("weight"))
    sequences = cut_lineage(sequences.withColumnRenamed("depth", "length"))
    # The digest of a sequence is needed no more once its prefixes are known.
    facts = sequences.select("of", "weight", "length")
    paths = decided(placed, facts, F.col("conv_id") == F.col("of"), "inner", F.lit(24))
    columns = ["of", "weight", "length", "depth", "parent", "node", "bytes"]
    root = facts.select("*", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("bytes"))
    paths = cut_lineage(paths.select(columns).unionAll(root.select(columns)))
    prefixes = paths.where("depth < length").select(F.col("depth").alias("length"), "node").distinct()
    leaves = sequences.join(prefixes, ["length", "node"], "left_anti").select("of", F.lit(1).alias("leaf"))

    nodes = paths.groupBy("depth", "node").agg(
        F.min("of").alias("conv_id"), F.sum("weight").alias("n_convs"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes")
    )
    nodes = nodes.withColumn("saves", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = cut_lineage(running_sum(nodes, "conv_id", [F.col("depth")], "saves", ("__place", "above", "__with")))

    # Sums over what lies below.
    owned = nodes.groupBy(F.col("conv_id").alias("of")).agg(F.sum("saves").alias("owned"))
    sums = cut_lineage(sequences.select("of").join(owned, "of", "left").join(leaves, "of", "left").fillna(0).withColumnRenamed("of", "__of"))
    through = decided(paths.select("of", "depth", "node"), sums, F.col("of") == F.col("__of"), "inner", F.lit(20))
    through = through.groupBy("depth", "node").agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("n_leaves"))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("__depth"), F.col("node").alias("__node"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(through, ["depth", "node"]).join(children, ["depth", "node"], "left").join(_ends(whole), ["depth", "node"], "left")
    found = decided(found, above, (F.col("depth") == F.col("__depth")) & (F.col("parent") == F.col("__node")), "left", F.lit(32))
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("owned") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "node",
    )


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie (see ``trie``) of conversations as they are, turns in order of ``turn``.

    NULL turns come first; rows of one turn are in the order of a digest of role and
    text, so reruns agree and repeated rows stay. A NULL role or text is empty; rows with a
    NULL id belong to no conversation; other columns are not looked at; no rows, no rows."""
    rows = cut_lineage(narrow(turns, conv_id, turn, role, text))
    return trie(rows, rows.select("conv_id").distinct(), ["turn", "said"])
