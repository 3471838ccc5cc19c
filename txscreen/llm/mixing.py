"""Mixing sources to target weights, with DataFrame functions only.

The words of a source are one stream: its documents in order of (hash bucket, doc_id, size). The
stream is cut into blocks of BLOCK words and a shorter tail. A source's target is met in epochs over
its blocks; every epoch reads the blocks in an order of its own, a keyed permutation of the indexes
that is evaluated index by index (a four-round Feistel network over a rectangle, walked until it falls
inside the range), and the last epoch stops at the target. Each read is a slot.

The mix is cut into output shards of about SHARD_SLOTS slots. How many slots a shard takes of each
source is a multinomial draw, made slot by slot with a keyed hash and counted; it has the source's slots
as its total, so targets are met whatever is drawn. The counts decide which slots a shard has: those
after the slots of the shards before it. A shard maps its slots through the permutations to block
indexes, and blocks are joined to documents by (source, index).

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share all words by
weight; a target stops at MOST times its source's size and the rest is shared again until none is
above. That is one water level over the sources, found with cumulative sums over one row for each source.

Offsets come from sums of (source, bucket) first, so a source with most of the rows is summed by many
tasks. Seeds are constants, so reruns agree.

Defined cases: a null text has size 0 and nothing is taken of it; a null source is a source of its
own; repeated rows are documents of their own; a null doc_id sorts first; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, partitions, settle, table

WEIGHTS, MOST = (5, 2, 1), 3
BLOCK, BUCKETS, SHARD_SLOTS, SEED = 512, 512, 1 << 16, 42
#: Slots that one row unfolds to at most.
_CHUNK = 4096
_WALKS = 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """sizes: (source, source_size), a row for each source. Adds weight and target."""
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("double")
    rows = sizes.select("source", "source_size", weight.alias("weight")).withColumn("cap", F.col("source_size") * float(MOST))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / rest
    rows = rows.withColumn("level", level).withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    water = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return rows.select("source", "source_size", "weight", F.when(F.col("capped"), F.col("cap")).otherwise(water * F.col("weight")).alias("target"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """The place of index in a pseudorandom permutation of 0 .. n - 1 that the key chooses."""
    a = F.ceil(F.sqrt(n.cast("double")))
    b = F.ceil(n / a)

    def step(acc: Column, i: Column) -> Column:
        turn = F.xxhash64(F.lit(SEED), *key, i % 4, F.when(i % 2 == 0, acc["r"]).otherwise(acc["l"]))
        left = F.when(i % 2 == 0, F.pmod(acc["l"] + F.pmod(turn, a), a)).otherwise(acc["l"])
        right = F.when(i % 2 == 0, acc["r"]).otherwise(F.pmod(acc["r"] + F.pmod(turn, b), b))
        moved = F.struct(left.alias("l"), right.alias("r"), ((i % 4 == 3) & (left * b + right < n)).alias("done"))
        return F.when(acc["done"], acc).otherwise(moved)

    start = F.struct(F.floor(index / b).alias("l"), F.pmod(index, b).alias("r"), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(4 * _WALKS - 1)), start, step)
    # n up to 100 needs 10 walks at most; beyond, one walk in sqrt(n) leaves the range
    return F.when(end["done"], end["l"] * b + end["r"]).otherwise(F.raise_error(F.lit("the index left the range in every walk")).cast("long"))


def placed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, key, size, bucket, n, offset): each document's place in the stream of its source, settled."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = settle(rows.withColumn("key", key).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))))
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("key", "bucket").orderBy("doc_id", "size")
    within = F.coalesce(F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = rows.withColumn("n", F.row_number().over(own)).withColumn("within", within)
    placed = dealt.join(bases, ["key", "bucket"]).withColumn("offset", F.col("base") + F.col("within"))
    return settle(placed.select("doc_id", "source", "key", "size", "bucket", "n", "offset"))


def slot_plan(targets: DataFrame) -> DataFrame:
    """(key, source_size, full, epochs, left, per, n, shards), a row for each source: how many slots it has, and how they make up its target."""
    size, want = F.col("source_size"), F.floor("target")
    plan = targets.where(F.col("source_size") > 0).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), "source_size",
        F.floor(size / BLOCK).alias("full"), F.floor(want / size).alias("epochs"), (want - F.floor(want / size) * size).alias("left"),
    )
    # an epoch has its full blocks and the tail, the last one only what it needs
    plan = plan.withColumn("per", F.col("full") + 1)
    last = F.when(F.col("left") > F.col("full") * BLOCK, F.col("per")).otherwise(F.ceil(F.col("left") / BLOCK))
    plan = plan.withColumn("n", F.col("epochs") * F.col("per") + last).where(F.col("n") > 0)
    return plan.withColumn("shards", F.ceil(F.sum("n").over(Window.partitionBy()) / SHARD_SLOTS))


def shard_draw(plan: DataFrame) -> DataFrame:
    """slot_plan() with (shard, slots, first): the source counts of each shard that has any, and the first slot of its source.

    Each of a source's n slots chooses a shard, so its counts over the shards are one multinomial draw of n.
    """
    chunks = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _CHUNK))))
    chunks = chunks.repartition(partitions(plan.sparkSession), "key", "chunk")
    draws = chunks.withColumn("draw", F.explode(F.sequence(F.col("chunk") * _CHUNK, F.least(F.col("chunk") * _CHUNK + _CHUNK, F.col("n")) - 1)))
    shard = F.pmod(F.xxhash64(F.lit(SEED), F.lit("shard"), "key", "draw"), F.col("shards"))
    counts = draws.groupBy(*plan.columns, shard.alias("shard")).agg(F.count(F.lit(1)).alias("slots"))
    before = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def slots(targets: DataFrame) -> DataFrame:
    """The mix: (key, shard, slot, block, words, whole), a row for each block read; words counts from the block's start."""
    spark = targets.sparkSession
    # counts of at most _CHUNK slots, so that a row doesn't unfold to more
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _CHUNK)))
    parts = shard_draw(slot_plan(targets)).withColumn("part", part).repartition(partitions(spark), "key", "shard", "part")
    begin = F.col("first") + F.col("part") * _CHUNK
    end = F.least(begin + _CHUNK, F.col("first") + F.col("slots"))
    each = parts.withColumn("slot", F.explode(F.sequence(begin, end - 1)))
    each = each.withColumn("epoch", F.floor(F.col("slot") / F.col("per"))).withColumn("at", F.pmod(F.col("slot"), F.col("per")))
    size = F.col("source_size")
    length = F.when(F.col("at") < F.col("full"), F.lit(BLOCK)).otherwise(size - F.col("full") * BLOCK)
    limit = F.when(F.col("epoch") < F.col("epochs"), size).otherwise(F.col("left"))
    block = F.when(F.col("at") < F.col("full"), permuted(F.col("at"), F.col("full"), F.col("key"), F.col("epoch"))).otherwise(F.col("full"))
    each = each.withColumn("length", length).withColumn("words", F.least(F.col("length"), F.greatest(F.lit(0), limit - F.col("at") * BLOCK)))
    return each.select("key", "shard", "slot", block.alias("block"), "words", (F.col("words") == F.col("length")).alias("whole")).where(F.col("words") > 0)


def _pieces(placed: DataFrame) -> DataFrame:
    """placed_documents() with a row for each block that a document has words in: block, and from and to in it."""
    end = F.col("offset") + F.col("size")
    blocks = F.sequence(F.floor(F.col("offset") / BLOCK), F.floor(F.greatest(F.col("offset"), end - 1) / BLOCK))
    cut = placed.withColumn("block", F.explode(blocks))
    return cut.withColumn("from", F.greatest(F.col("offset") - F.col("block") * BLOCK, F.lit(0))).withColumn("to", F.least(end - F.col("block") * BLOCK, F.lit(BLOCK)))


def shard_rows(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The shards themselves: (shard, key, slot, doc_id, first, words), words of a document from its word `first` on, for each slot."""
    placed = placed_documents(docs, doc_id, source, text)
    targets = settle(source_targets(placed.groupBy("source").agg(F.sum("size").alias("source_size"))))
    joined = _pieces(placed.where(F.col("size") > 0)).join(slots(targets), ["key", "block"])
    words = F.least(F.col("to"), F.col("words")) - F.col("from")
    first = F.col("block") * BLOCK + F.col("from") - F.col("offset")
    return joined.select("shard", "key", "slot", "doc_id", first.alias("first"), words.alias("words")).where(F.col("words") > 0)


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), a row for each document."""
    placed = placed_documents(docs, doc_id, source, text)
    targets = settle(source_targets(placed.groupBy("source").agg(F.sum("size").alias("source_size"))))
    # at most one read of a block is not whole: the last of its source
    used = slots(targets).groupBy("key", "block").agg(F.sum(F.col("whole").cast("long")).alias("copies"), F.max(F.when(~F.col("whole"), F.col("words"))).alias("part"))
    taken = F.coalesce(F.col("copies"), F.lit(0)) * (F.col("to") - F.col("from")) + F.greatest(F.lit(0), F.least(F.col("to"), F.coalesce(F.col("part"), F.lit(0))) - F.col("from"))
    sums = _pieces(placed).join(used, ["key", "block"], "left").groupBy("doc_id", "source", "key", "bucket", "n", "size").agg(F.sum(taken).alias("taken"))
    own = targets.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), "source_size", "target")
    return sums.join(own, "key").select("doc_id", "source", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", size: str = "_size", taken: str = "_taken") -> DataFrame:
    """docs with columns `size` and `taken`, which replace columns of these names.

    Equal rows share their takings evenly, as nothing tells them apart.
    """
    docs = docs.drop(size, taken)
    doc, src, words = free_names(docs, "doc", "src", "words")
    own = mix_sources(docs, doc_id, source, text).groupBy(F.col("doc_id").alias(doc), F.col("source").alias(src), F.col("size").alias(words)).agg(F.avg("taken").alias(taken))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(doc)) & F.col(source).cast("string").eqNullSafe(F.col(src)) & (word_count(text) == F.col(words))
    return docs.join(own, same).withColumnRenamed(words, size).drop(doc, src)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
