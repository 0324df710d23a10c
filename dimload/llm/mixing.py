"""Mixing sources to target weights, in DataFrame operations only.

Every source's words stand in one long line, cut into blocks of equal length. Output
shards draw how many slots each source gets; a source's slots take its blocks in a
pseudorandom order, once per pass over the source; slots and blocks are joined by
their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimload.llm.common import as_rows, back, decided, text_key, words
from dimload.operators.keys import row_numbers
from dimload.sources.scratch import cut_lineage

#: Words in a block, slots in an output shard, rounds of the permutation.
BLOCK, SHARD, ROUNDS = 256, 256, 20
#: No source, and so no document, is taken more often than this.
MOST = 3
#: About so many documents, or sources, are brought in line by one task at a time.
CHUNK = 4_000
#: Slots that one task fills, about.
SLOTS = 50_000


def permuted(x: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of 0..n-1 sends x: in each round x and its mirror
    image about a random point change places or stay, by a coin both share."""

    def step(at: Column, r: Column) -> Column:
        mirror = (F.pmod(F.xxhash64(r, key), n) + n - at) % n
        coin = F.xxhash64(F.greatest(at, mirror), r, key).bitwiseAND(F.lit(1).cast("long"))
        return F.when(coin == 1, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(rounds).cast("long")), x, step)


def _before(df: DataFrame, value: str, into: str, within: list[str], order: list[str], chunk: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, ``chunk`` first and then by ``order``.
    Only the sums of chunks meet, not their rows."""
    here = Window.partitionBy(*within, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*within).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    base = df.groupBy(*within, chunk).agg(F.sum(value).alias("__sum"))
    base = base.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    out = df.join(base, [*within, chunk]).withColumn(into, F.coalesce(F.sum(value).over(here), F.lit(0)) + F.col("__base"))
    return out.drop("__base")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, text_key, size``: the words of every row, 0 for a NULL text."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        text_key(text).alias("text_key"),
        F.size(words(text)).cast("long").alias("size"),
    )


def source_targets(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``sid, source, source_size, weight, target, quota`` of every source.

    Sources in order of code points, NULL last, weigh 1, 2, 3 and again; they share all
    sizes by weight. A target stops at ``most`` times its source's size, what is over
    is shared by the others' weights until none is above. The level is found by
    repeated sums over sources; two numbers a round reach the driver.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = row_numbers(sources, "sid", [F.col("source").isNull(), F.col("source")])
    sources = cut_lineage(sources.withColumn("weight", (F.col("sid") - 1) % 3 + 1))
    all_words, all_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (all_words or 0) / (all_weight or 1), None
    cap = F.col("source_size") * most
    while True:
        over = cap <= F.col("weight") * F.lit(float(level))
        held, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count_if(over),
        ).first()
        if n == capped or not weight:
            break
        level, capped = (all_words - held) / weight, n
    target = F.least(F.col("weight") * F.lit(float(level)), cap.cast("double"))
    sources = sources.withColumn("target", target)
    return sources.withColumn("quota", F.least(F.floor(F.col("target") + 0.5).cast("long"), cap))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, sources, spans)``.

    ``rows``: one per row of ``docs`` with ``doc_id, source, text_key, size, sid, start``
    (its place in its source's line of words; together with ``sid`` it names a row that
    has words). ``sources``: see ``source_targets``. ``spans``: which words of which row
    stand in which slot of which shard: ``shard, sid, slot, pass, start, word_from,
    word_to``.

    A source takes exactly ``quota`` words, its target rounded: whole passes over all
    its blocks, then a part of a pass, whose last block is cut. The last, shorter block
    of a source ends a pass. Shards draw their slots' sources at random, in proportion
    to the sources' slots (a multinomial draw per shard); what a source was drawn too
    often is then given, in order, to the sources drawn too seldom, so totals are kept
    and about one slot in a hundred changes. No row is taken more than ``most`` times.

    Reruns agree, whatever the order of the input: lines are ordered by a hash of the
    id, the id, size and text. A NULL source is a source; a NULL or wordless text has
    size 0 and is taken 0 words; repeated rows stand in line one after the other; other
    columns are not looked at; no rows, no rows.

    No source is brought to one task: places in line are summed up in chunks, slots are
    counted per shard before they meet, and the joins are on (source, block).
    """
    rows = cut_lineage(sized(docs, doc_id, text, source))
    sources = cut_lineage(source_targets(rows))
    number = F.col("source_size")
    sources = (
        sources.withColumn("full", F.floor(number / block).cast("long"))
        .withColumn("blocks", F.ceil(number / block).cast("long"))
        .withColumn("passes", F.when(number > 0, F.floor(F.col("quota") / number).cast("long")).otherwise(F.lit(0)))
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil((F.col("quota") - F.col("passes") * number) / block).cast("long"))
        .withColumn("chunk", F.floor(F.col("sid") / CHUNK).cast("long"))
        .withColumn("one", F.lit(1))
    )
    sources = cut_lineage(_before(sources, "slots", "low", ["one"], ["sid"], "chunk"))
    total, kinds, n_docs = (*sources.agg(F.sum("slots"), F.count("*")).first(), rows.count())
    total = int(total or 0)

    # Places in line.
    known = sources.select("sid", F.col("source").alias("__source"))
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    chunks = max(1, n_docs // CHUNK)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    rows = cut_lineage(_before(rows, "size", "start", ["sid"], ["doc_id", "size", "text_key"], "chunk").drop("chunk"))

    # Draws: each slot hits a number below all slots; cells of equal width name the sources there.
    width = max(1, total // (4 * max(1, kinds)))
    high = F.col("low") + F.col("slots")
    cells = sources.where("slots > 0").select(
        "sid",
        "low",
        high.alias("high"),
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((high - 1) / width))).alias("cell"),
    )
    spark = docs.sparkSession
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard).cast("long").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, total))).alias("hit")
    )
    draws = draws.withColumn("in_cell", F.floor(F.col("hit") / width))
    draws = decided(draws, cut_lineage(cells), F.col("in_cell") == F.col("cell"), "inner", F.lit(0))
    counts = draws.where("low <= hit and hit < high").groupBy("sid", "shard").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts.withColumn("chunk", F.floor(F.col("shard") / CHUNK).cast("long")))
    counts = cut_lineage(_before(counts, "n", "first", ["sid"], ["shard"], "chunk").drop("chunk"))

    # Settlement: what one source was drawn too often goes to those drawn too seldom.
    drawn = counts.groupBy("sid").agg(F.sum("n").alias("drawn"))
    balance = sources.join(drawn, "sid", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    balance = balance.withColumn("over", F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)))
    balance = balance.withColumn("under", F.greatest(F.col("slots") - F.col("drawn"), F.lit(0)))
    balance = _before(balance, "over", "over_before", ["one"], ["sid"], "chunk")
    balance = cut_lineage(_before(balance, "under", "under_before", ["one"], ["sid"], "chunk"))
    # A count becomes many slots: few bytes, much to do.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // SLOTS)
    spread = counts.repartition(tasks, "sid", "shard")
    drawn = spread.select("sid", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    drawn = drawn.join(balance.select("sid", "slots", "over_before"), "sid")
    spare = drawn.where("slot >= slots").select("shard", (F.col("over_before") + F.col("slot") - F.col("slots")).alias("g"))
    missing = balance.where("under > 0").select(
        "sid", "drawn", "under_before", F.explode(F.sequence(F.col("drawn"), F.col("slots") - 1)).alias("slot")
    )
    missing = missing.select("sid", "slot", (F.col("under_before") + F.col("slot") - F.col("drawn")).alias("g"))
    placed = drawn.where("slot < slots").select("shard", "sid", "slot").unionAll(spare.join(missing, "g").select("shard", "sid", "slot"))

    # Slots to blocks.
    facts = sources.select("sid", "source_size", "quota", "blocks", "full")
    placed = placed.join(facts, "sid").withColumn("pass", F.floor(F.col("slot") / F.col("blocks")).cast("long"))
    placed = placed.withColumn("place", F.col("slot") - F.col("pass") * F.col("blocks"))
    key = F.xxhash64("sid", "pass", F.lit(seed))
    taken = placed.select(
        "shard",
        "sid",
        "slot",
        "pass",
        F.when(F.col("place") < F.col("full"), permuted(F.col("place"), F.greatest(F.col("full"), F.lit(1)), key))
        .otherwise(F.col("full"))
        .alias("block"),
        F.least(F.lit(block), F.col("quota") - F.col("pass") * F.col("source_size") - F.col("place") * block).alias("take"),
    )

    # Blocks to rows.
    end = F.col("start") + F.col("size")
    pieces = rows.where("size > 0").select(
        "sid", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block")
    )
    begin = F.col("block") * block
    word_from = F.greatest(begin, F.col("start"))
    word_to = F.least(begin + F.col("take"), F.col("start") + F.col("size"))
    spans = taken.join(pieces, ["sid", "block"]).where(word_from < word_to)
    spans = spans.select(
        "shard", "sid", "slot", "pass", "start", (word_from - F.col("start")).alias("word_from"), (word_to - F.col("start")).alias("word_to")
    )
    return rows, sources, spans


def words_taken(rows: DataFrame, sources: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with ``source_size, target`` and ``taken``, the words the mix takes from each."""
    taken = spans.groupBy("sid", "start").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    # A row without words begins where the next one does: it must not get that one's words.
    taken = taken.withColumn("some", F.lit(True))
    out = rows.withColumn("some", F.col("size") > 0).join(taken, ["sid", "start", "some"], "left")
    out = out.join(sources.select("sid", "source_size", "target"), "sid")
    return out.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).drop("some")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: for each row of ``docs`` and each pass that takes words of it,
    the row with those words as its text (and their code points as ``n_chars``, if there
    is such a column). A row taken whole keeps its text as it is; else its words keep
    the white space before them. Rows that repeat id, source and text get the columns
    of one of them."""
    rows, _, spans = mix(docs, doc_id, text, source, **options)
    repeated = rows.groupBy("doc_id", "source", "text_key").agg(F.count("*").alias("n")).where("n > 1")
    parts = spans.groupBy("sid", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("word_from", "word_to"))).alias("spans"))
    parts = parts.join(rows.where("size > 0"), ["sid", "start"])
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x.word_to - x.word_from) == F.col("size")
    parts = parts.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_key").alias("__key"), F.when(~whole, F.col("spans")).alias("spans")
    )
    parts = cut_lineage(parts)
    texts = as_rows(docs, text, id=doc_id, src=source)
    texts = texts if repeated.isEmpty() else texts.dropDuplicates(["id", "src", "key"])
    there = F.col("id").eqNullSafe(F.col("__id")) & F.col("src").eqNullSafe(F.col("__source")) & (F.col("key") == F.col("__key"))
    width = F.coalesce(F.octet_length("__source"), F.lit(0)) + 24 * F.coalesce(F.size("spans"), F.lit(0))
    both = decided(texts, parts, there, "inner", width).withColumn("whole", F.col("spans").isNull())
    units = F.regexp_extract_all(F.col("row")[text], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    both = both.withColumn("units", F.when(~F.col("whole"), units))
    cut = F.transform("spans", lambda s: F.slice("units", (s.word_from + 1).cast("int"), (s.word_to - s.word_from).cast("int")))
    left = F.regexp_replace(F.array_join(F.flatten(cut), ""), r"^[\x20\x09-\x0D]+", "")
    return back(both, docs, text, F.when(F.col("whole"), F.col("row")[text]).otherwise(left))
