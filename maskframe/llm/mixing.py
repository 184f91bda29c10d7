"""Mixing sources to target weights, by blocks of words that are drawn by index; DataFrame functions only.

The words of each source, its documents one after another in an order that hashes give, are packed into blocks of BLOCK words.
Sources in order of their names get weights and, by these, shares of all words; a source stops at LIMIT times its own, and what
that leaves goes to the others by weight, until none is above. A target is so many whole passes over a source's blocks and a part
of one more, which makes the source's number of slots.

All slots of the mix lie in shards of SHARD slots. One pseudorandom permutation deals the sources' slots over them, so a shard's
counts of each source are a multinomial draw, given the totals (`shard_counts`). Free draws would miss a target by the square root
of its slots and pass the limit half the time where a source is at it. A source's slots number its draws, and each pass maps them
to the source's blocks by a permutation of its own, a source's short last block being the last of the pass; slots and blocks then
meet by source and index. The last slot of a part pass is filled only as far as the target goes. Permutations are swap-or-not
shuffles, exact on any number of places.

Nothing is ordered or summed in one task: rows are ordered within 4096 hash ranges of a source, sources within ranges of names.

Edge cases: null and empty texts and those of blanks have size 0 and give 0 words; a null source is one of its own and the last;
repeated rows are counted, placed and returned each by itself (a copy has its own words in the blocks, so copies may differ in what
is taken of them); ties of the order are between equal rows only; a null doc_id is a document; long texts lie in as many blocks as
they need; an empty table gives an empty result; only doc_id, text and source are read, other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, LIMIT = (5, 2, 1), 3
#: Words of a block, slots of a shard, hash ranges of a source, rounds of a permutation, rows that one row becomes at once.
BLOCK, SHARD, RANGES, ROUNDS, STEP = 128, 4096, 4096, 24, 4096
#: Slots that a task draws. Slots are as many as blocks, but Spark sees a few rows of sources: joins with them are told to shuffle.
SLOTS = 1 << 16


def permuted(at: Column, n: Column, *seed: Column) -> Column:
    """Where the place `at` of 0 to n - 1 goes: in each round a place and its mirror image at a key change places or don't."""

    def step(x: Column, k: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*seed, k), n) - x, n)
        return F.when(F.xxhash64(*seed, k, F.greatest(x, mirror)) < 0, mirror).otherwise(x)

    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), at, step)


def numbers(df: DataFrame, n: str, name: str, tasks: int = 0) -> DataFrame:
    """A row for each of 0 to n - 1, in two steps, so that no row holds a long array; if asked, the second in so many tasks."""
    part = df.withColumn("_part", F.explode(F.expr(f"if({n} > 0, sequence(0L, ({n} - 1) div {STEP}), array())")))
    if tasks:
        part = part.repartition(tasks, "no", "_part")
    return part.withColumn(name, F.explode(F.expr(f"sequence(_part * {STEP}, least(_part * {STEP} + {STEP}, {n}) - 1)"))).drop("_part")


def measured(documents: DataFrame) -> DataFrame:
    """Each document's source, as a key in the sources' order, its words, and its place in the order of its source."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), size.alias("size"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("tie"))
    return rows.withColumn("range", F.pmod("tie", F.lit(RANGES)))


def running(df: DataFrame, value: Column, name: str) -> DataFrame:
    """With the sum of the values before each row, in order of parts and keys. Rows across parts are one for each part."""
    inside = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy("part").agg(F.sum(value).alias("_n")).select("part", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before"))
    return df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(parts, "part").withColumn(name, F.col(name) + F.col("_before")).drop("_before")


def with_targets(sources: DataFrame) -> DataFrame:
    """Targets by weight, none above LIMIT times its source. The driver gets four sums a round."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("no") % len(WEIGHTS) + 1).cast("int"))
    known = sources.withColumn("weight", weight)
    most, level, full = F.col("source_size") * LIMIT, 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > most
        r = known.agg(F.count_if(above).alias("full"), F.sum("source_size").alias("all"), F.sum(F.when(above, most).otherwise(0)).alias("used"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights")).first()
        if r["full"] == full or not r["weights"]:
            return known.withColumn("target", F.when(above, most.cast("double")).otherwise(F.col("weight") * F.lit(level)))
        full, level = r["full"], max(level, (r["all"] - r["used"]) / r["weights"])


def with_slots(sources: DataFrame) -> DataFrame:
    """With the number of a source's blocks and slots, and the words of its last slot."""
    words = sources.withColumn("words", F.least(F.rint("target").cast("long"), F.col("source_size") * LIMIT)).withColumn("blocks", F.expr(f"(source_size + {BLOCK - 1}) div {BLOCK}"))
    passes = words.withColumn("passes", F.expr("if(source_size > 0, words div source_size, 0L)")).withColumn("rest", F.expr("words - passes * source_size"))
    slots = passes.withColumn("more", F.expr(f"(rest + {BLOCK - 1}) div {BLOCK}"))
    return slots.withColumn("slots", F.expr("passes * blocks + more")).withColumn("last", F.expr(f"if(rest > 0, rest - (more - 1) * {BLOCK}, {BLOCK}L)"))


def laid_out(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The sources (no, key, source_size, target, blocks, slots, first slot, ...) and the distinct documents (no, key, tie, doc_id,
    size, copies, begin), whose first copy's words begin at a place of their source's."""
    rows = scratch.save(measured(documents).groupBy("key", "range", "tie", "doc_id", "size").agg(F.count("*").alias("copies")))
    words = F.col("size") * F.col("copies")
    ranges = scratch.save(rows.groupBy("key", "range").agg(F.sum(words).alias("words")))
    sums = ranges.groupBy("key").agg(F.sum("words").alias("source_size"))
    parts = scratch.save(sums.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    named = scratch.save(running(parts, F.lit(1).cast("long"), "no"))
    sources = scratch.save(running(with_slots(with_targets(named)), F.col("slots"), "first"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))).join(sources.select("key", "no"), "key").select("key", "range", "no", "start")
    within = Window.partitionBy("key", "range").orderBy("tie", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("start") + F.coalesce(F.sum(words).over(within), F.lit(0))
    placed = scratch.save(rows.join(starts, ["key", "range"]).select("no", "key", "tie", "doc_id", "size", "copies", begin.alias("begin")))
    scratch.drop(rows, ranges, parts, named)
    return sources, placed


def drawn(sources: DataFrame) -> DataFrame:
    """A row for each slot of the mix: its shard and place, the source and the index of its block, and the words it takes at most."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    draws = numbers(sources.select("no", "source_size", "first", "blocks", "slots", "last"), "slots", "draw", total // SLOTS + 1)
    at = permuted(F.col("first") + F.col("draw"), F.lit(total).cast("long"), F.lit("slots"))
    place, full = F.expr("draw % blocks"), F.expr(f"source_size div {BLOCK}")
    block = F.when(place < full, permuted(place, F.greatest(full, F.lit(1)), F.col("no"), F.expr("draw div blocks"))).otherwise(place)
    most = F.when(F.col("draw") == F.col("slots") - 1, F.col("last")).otherwise(F.lit(BLOCK))
    return draws.select(at.alias("_at"), "no", block.alias("block"), most.alias("most")).select(F.expr(f"_at div {SHARD}").alias("shard"), F.expr(f"_at % {SHARD}").alias("place"), "no", "block", "most")


def shard_counts(sources: DataFrame) -> DataFrame:
    """How many slots of each source a shard has."""
    return drawn(sources).groupBy("shard", "no").agg(F.count("*").alias("slots"))


def segments(placed: DataFrame) -> DataFrame:
    """The stretches of documents, copy by copy, that lie in the blocks: [from, to) in the block's words."""
    copies = numbers(placed.filter("size > 0"), "copies", "copy").withColumn("begin", F.expr("begin + copy * size"))
    rows = copies.withColumn("block", F.explode(F.expr(f"sequence(begin div {BLOCK}, (begin + size - 1) div {BLOCK})")))
    return rows.withColumn("from", F.expr(f"greatest(begin - block * {BLOCK}, 0L)")).withColumn("to", F.expr(f"least(begin + size - block * {BLOCK}, {BLOCK}L)"))


def taken(documents: DataFrame) -> DataFrame:
    """For each document (doc_id, size, source_size, target, taken)."""
    scratch = Scratch(documents.sparkSession)
    sources, placed = laid_out(documents, scratch)
    met = segments(placed).select("no", "block", "begin", "doc_id", "size", "from", "to").join(drawn(sources).select("no", "block", "most").hint("merge"), ["no", "block"], "left")
    some = met.groupBy("no", "begin", "doc_id", "size").agg(F.sum(F.expr("if(most > from, least(to, most) - from, 0L)")).alias("taken")).drop("begin")
    none = numbers(placed.filter("size = 0"), "copies", "copy").select("no", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none).join(sources.select("no", "source_size", "target"), "no").select("doc_id", "size", "source_size", "target", "taken")


def mixed(documents: DataFrame) -> DataFrame:
    """The mix itself: (shard, place, source, block, words), a row for each slot; a slot has BLOCK words, fewer at a source's end."""
    scratch = Scratch(documents.sparkSession)
    sources, placed = laid_out(documents, scratch)
    texts = documents.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("tie"), F.col("doc_id").cast("long").alias("_id"), "text").groupBy("tie", "_id").agg(F.first("text").alias("text"))
    held = placed.join(texts, (placed["tie"] == texts["tie"]) & placed["doc_id"].eqNullSafe(texts["_id"])).drop("tie", "_id", "doc_id")
    words = F.expr(f"slice(regexp_extract_all(text, r'{WORD}', 0), cast(block * {BLOCK} + from - begin + 1 as int), cast(to - from as int))")
    pieces = segments(held).select("no", "block", "from", words.alias("words"))
    blocks = pieces.groupBy("no", "block").agg(F.sort_array(F.collect_list(F.struct("from", "words"))).alias("pieces"))
    whole = blocks.select("no", "block", F.flatten(F.col("pieces.words")).alias("words"))
    source = F.expr("if(key = '~', null, substr(key, 2))").alias("source")
    filled = drawn(sources).hint("merge").join(whole, ["no", "block"]).join(sources.select("no", source), "no")
    return filled.select("shard", "place", "source", "block", F.expr("slice(words, 1, cast(most as int))").alias("words"))


def op11_source_mix(spark, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))
