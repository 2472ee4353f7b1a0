"""Mix sources to target weights by a low-discrepancy schedule.

1. Targets: the mix is as large as all words together. Sources share it by weight; a
   source stops at ``max_epochs`` times its own size and the excess is shared again by
   weight (water filling, solved in closed form over one row per source).
2. Blocks: the documents of a source, shuffled by a digest of their id, stand in a row
   and are cut into blocks of ``block_words`` words (the last one shorter).
3. Schedule: slot i of the mix belongs to the source in whose part of the cumulated
   targets the i-th van der Corput point lies. The slots of a source are ranked; the
   slot of rank r takes block ``r mod blocks`` in pass ``r div blocks``, so every prefix of
   the schedule holds the sources near their targets. Slots end where a source has its
   target: the last takes only the words that are missing. What the points leave a
   source short of (a few slots) follows the schedule, without slot numbers.
4. A document's taken words are its words in the blocks taken, repeats counted.

Rows: null and empty texts have size 0 and are never taken. Null is a source of its
own, the last. Rows that agree in doc_id are ordered by size; equal rows are
interchangeable. Sources without words have target 0. Empty tables give empty results.
Other columns stay out of the result.

A source with a third of all rows is no hot key: rows are ordered within runs of the
digest, whose starts come from the runs' totals, and a target travels with the runs.
Windows over the whole see one row per source only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketlens.llm.common import WORD, partitions, written

#: Words of a block and of a slot.
BLOCK_WORDS = 256
MAX_EPOCHS = 3
_BEFORE = (Window.unboundedPreceding, -1)


def sized(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, source, a key for it without nulls, size (words of the text), digest and its run."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    run = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * runs / (1 << 32))
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source"))
    return docs.select("doc_id", "source", key.alias("key"), size.alias("size"), digest.alias("digest")).withColumn(
        "run", run
    )


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (source, source_size): weight and target of each source.

    Weights are 1, 2, 3 in turn by code point of the source, null last. With the caps
    ``max_epochs * source_size``, the targets are min(cap, level * weight) for the level at
    which they sum to the total: sources are capped in order of cap / weight, as long as
    sharing what is left would lift them over their cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighted = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    filled = (
        weighted.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(*_BEFORE)), F.lit(0.0)))
        .withColumn(
            "weights_left",
            F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        )
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("capped", F.col("cap") < F.col("level") * F.col("weight"))
    )
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight"))
    return filled.select("source", "source_size", "weight", target.alias("target"))


def quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """sources with the slots that each needs: whole passes, and words of the last one."""
    words = F.floor("target")
    safe = F.greatest("source_size", F.lit(1))
    return (
        sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(words / safe)).otherwise(0))
        .withColumn("rest", words - F.col("passes") * F.col("source_size"))
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
    )


def schedule(spark: SparkSession, quota: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot, key, block, words (that it takes of the block).

    Slot i has the i-th point of the van der Corput sequence in base 2: the bits of i
    behind the point, reversed. Points meet sources by equal cells of the unit interval.
    Ranks come from counts per run of slots, so no source is ranked in one task.
    """
    n, cells = -(-total // block_words), partitions(spark) * 4
    run_slots = max(1024, -(-n // cells))
    by_name = Window.orderBy("key_order", "key")
    shares = quota.where("target > 0").withColumn("key_order", F.col("key") == "")
    hi = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shares = shares.withColumn("hi", hi / F.sum("target").over(Window.partitionBy()))
    shares = shares.withColumn("lo", F.lag("hi", 1, 0.0).over(by_name))
    shares = shares.withColumn("hi", F.when(F.lead("key").over(by_name).isNull(), 1.0).otherwise(F.col("hi")))
    last_cell = F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1))
    shares = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), last_cell)))
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), 52, "0")), 2, 10).cast("double") / float(1 << 52)
    points = spark.range(0, n, 1, max(1, min(partitions(spark), n // 4096 + 1))).withColumnRenamed("id", "slot")
    points = points.withColumn("point", point).withColumn("cell", F.floor(F.col("point") * cells))
    slots = points.join(shares, "cell").where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
    slots = slots.select("slot", "key", F.floor(F.col("slot") / run_slots).alias("run"))
    run = Window.partitionBy("key", "run")
    slots = slots.withColumn("in_run", F.row_number().over(run.orderBy("slot")) - 1)
    counts = slots.groupBy("key", "run").agg(F.count("*").alias("n"))
    runs_before = Window.partitionBy("key").orderBy("run").rowsBetween(*_BEFORE)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(runs_before), F.lit(0))).drop("n")
    # what a run needs of its source travels with the run
    starts = starts.join(quota.select("key", "slots", "blocks", "passes", "rest"), "key")
    ranked = slots.join(starts, ["key", "run"]).withColumn("rank", F.col("start") + F.col("in_run"))
    ranked = ranked.where(F.col("rank") < F.col("slots"))
    have = counts.groupBy("key").agg(F.sum("n").alias("have"))
    short = quota.join(have, "key", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    short = short.where(F.col("have") < F.col("slots"))
    short = short.withColumn("rank", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)))
    columns = ["key", "rank", "blocks", "passes", "rest"]
    every = ranked.select("slot", *columns).unionByName(short.select(F.lit(None).cast("long").alias("slot"), *columns))
    block = F.col("rank") % F.col("blocks")
    left = F.when(F.floor(F.col("rank") / F.col("blocks")) < F.col("passes"), block_words).otherwise(
        F.least(F.lit(block_words), F.col("rest") - block * block_words)
    )
    return every.select("slot", "key", block.cast("long").alias("block"), left.cast("long").alias("words"))


def placed(spark: SparkSession, docs: DataFrame, max_epochs: int, block_words: int) -> tuple[DataFrame, DataFrame, int]:
    """Documents with their place in the order of their source; the sources' quotas; all words."""
    runs = partitions(spark) * 4
    rows = written(sized(docs, runs))
    totals = written(rows.groupBy("key", "source", "run").agg(F.sum("size").alias("n")))
    sources = targets(totals.groupBy("source").agg(F.sum("n").alias("source_size")), max_epochs)
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source"))
    quota = written(quotas(sources.withColumn("key", key), block_words))
    runs_before = Window.partitionBy("key").orderBy("run").rowsBetween(*_BEFORE)
    starts = totals.withColumn("start", F.coalesce(F.sum("n").over(runs_before), F.lit(0))).drop("n", "source")
    starts = starts.join(quota.select("key", "source_size", "target"), "key")
    in_run = Window.partitionBy("key", "run").orderBy("digest", "doc_id", "size").rowsBetween(*_BEFORE)
    rows = rows.withColumn("in_run", F.coalesce(F.sum("size").over(in_run), F.lit(0))).join(starts, ["key", "run"])
    rows = rows.withColumn("pos", F.col("start") + F.col("in_run"))
    total = quota.agg(F.sum("source_size")).first()[0] or 0
    return rows.select("doc_id", "source", "key", "size", "pos", "source_size", "target"), quota, int(total)


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (of its source), taken (words).

    first_slot is the earliest slot that takes words of it, null where none does or only
    slots that follow the schedule.
    """
    spark = docs.sparkSession
    rows, quota, total = placed(spark, docs, max_epochs, block_words)
    slots = schedule(spark, quota, total, block_words)
    picks = slots.groupBy("key", "block").agg(
        F.count_if(F.col("words") == block_words).alias("whole"),
        F.coalesce(F.sum(F.when(F.col("words") < block_words, F.col("words"))), F.lit(0)).alias("part"),
        F.min(F.when(F.col("words") == block_words, F.col("slot"))).alias("whole_slot"),
        F.min(F.when(F.col("words") < block_words, F.col("slot"))).alias("part_slot"),
    )
    end = F.col("pos") + F.col("size")
    blocks = F.sequence(F.floor(F.col("pos") / block_words), F.floor((end - 1) / block_words))
    pieces = rows.withColumn("block", F.explode(F.when(F.col("size") > 0, blocks).otherwise(F.array(F.lit(-1).cast("long")))))
    first = F.col("block") * block_words
    lo, hi = F.greatest("pos", first), F.least(end, first + block_words)
    taken = F.col("whole") * (hi - lo) + F.greatest(F.least(hi, first + F.col("part")) - lo, F.lit(0))
    reached = F.when(lo < first + F.col("part"), F.least("whole_slot", "part_slot")).otherwise(F.col("whole_slot"))
    pieces = pieces.join(picks, ["key", "block"], "left").withColumns({"slot": reached, "taken": F.coalesce(taken, F.lit(0))})
    same = ["doc_id", "source", "key", "pos", "size", "source_size", "target"]
    # rows that agree in all of these (no words, repeated) stay apart by their count
    out = pieces.groupBy(*same).agg(
        F.sum("taken").alias("taken"), F.min("slot").alias("first_slot"), F.count_if(F.col("block") == -1).alias("empty")
    )
    out = out.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("empty", F.lit(1).cast("long")))))
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "first_slot")


def mixed_documents(docs: DataFrame, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix: a row of docs once per whole time that its words are taken.

    Words taken beyond whole times (of the one or two documents of a source where its
    target ends) make one more row with that many first words, joined by spaces, and
    n_chars counted anew. A document that the mix does not take is not there.
    """
    # rows that agree in source, id and size take their turns, so that no row gets what another one takes
    turn = lambda order: F.row_number().over(Window.partitionBy("__name").orderBy(order))
    name = lambda size: F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size.cast("string"), F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source"))
    )
    takes = mix(docs, max_epochs, block_words).withColumn("__name", name(F.col("size")))
    takes = takes.select("__name", turn(F.desc("taken")).alias("__turn"), F.col("taken").alias("__taken")).where("__taken > 0")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.withColumns({"__size": size, "__name": name(size)})
    rows = rows.withColumn("__turn", turn(F.md5(F.coalesce("text", F.lit(""))))).join(takes, ["__name", "__turn"])
    times = F.ceil(F.col("__taken") / F.col("__size"))
    rows = rows.withColumn("__time", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    rest = (F.col("__taken") - (F.col("__time") - 1) * F.col("__size")).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1), 1, rest), " ")
    partial = rest < F.col("__size")
    rows = rows.withColumn("__text", F.when(partial, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.length("__text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(partial, chars).otherwise(F.col("n_chars")))
    return rows.withColumn("text", F.col("__text")).select(*docs.columns)
