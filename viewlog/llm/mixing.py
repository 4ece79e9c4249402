"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source's texts lie on a word axis, in a seeded order, cut into blocks of
``block`` words. Blocks are seats: sources win them by highest quotients
``target / (2k - 1)``, a source's seats are shared among its shards the same
way by the shards' blocks, and each shard takes its seats as whole passes plus
a run of blocks from a seeded start. What a document contributes is the overlap
of its words with the taken blocks, computed by arithmetic on the axis.

Only built-in functions run. Per document one row of sizes is shuffled, never
text: documents are ordered within (source, slice), where the 4096 slices come
from the seeded order itself, so a source that holds a third of all rows is
spread over 4096 groups. The tables of sources and of shards (16 a source) are
as large as the mix's configuration.

Targets: the sources share 100 % of all words by weight; none exceeds ``passes``
times its own words, and the excess is shared again by weight among the rest
until none is above.

Defined results: a null or empty text has size 0 and nothing of it is taken; a
null source is a source of its own, ordered last; repeated rows are separate
documents; an empty table gives an empty result; other columns are ignored. Weights are positive;
sources that a given weight table leaves out are not part of the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.llm.common import WORD, small, written

BLOCK = 16
PASSES = 3
SEED = "mix"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: str = SEED) -> DataFrame:
    """``doc_id, source, skey, size, place``: ``skey`` is the source, never null; ``place`` the seeded order, a hex digest."""
    key, source = F.col(id_col).cast("string"), F.col(source_col).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), source.alias("source"),
        F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source)).alias("skey"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key, F.lit("")))).alias("place"))


def cyclic_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``skey, source, size, weight``: weights repeat over the sources in code-point order, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = F.array(*(F.lit(float(w)) for w in weights))
    at = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    return (sizes.groupBy("skey", "source").agg(F.sum("size").alias("size"))
            .withColumn("weight", F.element_at(order, at.cast("int"))))


def targets(sources: DataFrame, passes: int = PASSES) -> DataFrame:
    """Adds ``target``, ``cap`` and ``capped`` to ``source, size, weight``.

    The water level is closed form: with sources ordered by cap over weight,
    all before the first that stays below its cap are full.
    """
    one = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(ahead), F.lit(0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0))))
    first_below = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("rank", "level"))).over(one)["level"]
    return (sources.withColumn("cap", F.col("size") * passes).withColumn("total", F.sum("size").over(one))
            .withColumn("all_weight", F.sum("weight").over(one)).withColumn("rank", F.row_number().over(order))
            .withColumn("level", level).withColumn("water", first_below)
            .withColumn("capped", F.coalesce(F.col("water") * F.col("weight") >= F.col("cap"), F.lit(True)))
            .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double"))
                        .otherwise(F.col("water") * F.col("weight")))
            .drop("total", "all_weight", "level", "water", "rank"))


def apportion(rows: DataFrame, group: list[str], share: str, seats: str, ties: list[str]) -> DataFrame:
    """Adds ``won``: the ``seats`` of each group dealt to its rows by Sainte-Lague quotients.

    Rounding ``share * d`` for a divisor just too small to deal them all gives
    every row its sure seats at once; the rest (fewer than rows) go to the next
    quotients, of which each row can win a bounded number.
    """
    all_ = Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, total = F.count("*").over(all_), F.sum(share).over(all_)
    divided = F.try_divide(F.col(share) * F.greatest(F.col(seats) - F.col("_n") / 2, F.lit(0.0)), F.col("_total"))
    rows = rows.withColumn("_n", n).withColumn("_total", total)
    rows = rows.withColumn("_sure", F.coalesce(F.floor(divided + 0.5), F.lit(0)).cast("long"))
    rows = rows.withColumn("_left", F.when(F.col("_total") > 0, F.col(seats) - F.sum("_sure").over(all_)).otherwise(F.lit(0)))
    # A row's further seats are at most its share of n more, and one for rounding each.
    more = F.coalesce(F.ceil(F.try_divide(F.col(share), F.col("_total")) * F.col("_n")) + 2, F.lit(1)).cast("int")
    tries = rows.withColumn("_try", F.explode(F.sequence(F.lit(1), more)))
    quotient = F.col(share) / (F.col("_sure") + F.col("_try") - 0.5)
    best = Window.partitionBy(*group).orderBy(quotient.desc(), *(F.col(c).asc_nulls_last() for c in ties), F.col("_try"))
    keys = [c for c in rows.columns if not c.startswith("_")]
    return (tries.withColumn("_rank", F.row_number().over(best)).groupBy(*keys, "_sure")
            .agg(F.sum((F.col("_rank") <= F.col("_left")).cast("long")).alias("_extra"))
            .withColumn("won", F.col("_sure") + F.col("_extra")).drop("_sure", "_extra"))


def _blocks(words: Column, block: int) -> Column:
    return F.ceil(words / F.lit(float(block))).cast("long")


def mix(docs: DataFrame, sources: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block: int = BLOCK, passes: int = PASSES, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, source_size, target, taken``.

    ``sources`` (``source, weight``) names the weights; without it they repeat
    ``WEIGHTS`` over the sources in order.
    """
    sizes = written(sized(docs, id_col, text_col, source_col, seed), "sizes")
    if sources is None:
        weighted = cyclic_weights(sizes)
    else:
        own = sizes.groupBy("skey", "source").agg(F.sum("size").alias("size")).alias("a")
        weighted = (own.join(sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
                    .select("a.*", F.col("b.weight").cast("double").alias("weight")))
    goal = targets(weighted, passes).withColumn("blocks", _blocks(F.col("size"), block))

    # Seats of sources: a capped source takes every pass of every block, the others share the rest.
    one = Window.partitionBy("one").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_ = (goal.where("not capped").withColumn("one", F.lit(0))
             .withColumn("seats", F.round(F.sum("target").over(one) / block).cast("long")))
    won = apportion(open_, ["one"], "target", "seats", ["source"]).select("skey", "won")
    quota = F.when(F.col("capped"), F.col("blocks") * passes).otherwise(F.least(F.coalesce("won", F.lit(0)), F.col("blocks") * passes))
    # Whole passes go to every block; only the last, partial pass is apportioned to shards.
    goal = goal.join(won, "skey", "left").withColumn("quota", quota)
    goal = goal.withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("quota"), F.col("blocks"))), F.lit(0)).cast("long"))
    goal = written(goal.withColumn("rest", F.col("quota") - F.col("whole") * F.col("blocks")), "sources")

    # Words before each slice of a source: 4096 slices at most, in seeded order.
    in_slice = F.substring("place", 1, 3)
    before = Window.partitionBy("skey").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sizes.groupBy("skey", in_slice.alias("slice")).agg(F.sum("size").alias("words"))
    slices = written(slices.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))), "slices")

    # Shards are runs of slices (the first hex digit); a block belongs to the shard it starts in.
    shard = (slices.groupBy("skey", F.substring("slice", 1, 1).alias("shard"))
             .agg(F.min("base").alias("lo"), F.sum("words").alias("words"))
             .withColumn("first", _blocks(F.col("lo"), block))
             .withColumn("n_blocks", _blocks(F.col("lo") + F.col("words"), block) - F.col("first")))
    shard = shard.where("n_blocks > 0").join(goal.select("skey", "rest"), "skey")
    shard = apportion(shard, ["skey"], "n_blocks", "rest", ["shard"])
    shard = shard.withColumn("won", F.least("won", "n_blocks"))
    turn = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), "skey", F.lit(":"), "shard")), 1, 8), 16, 10).cast("long")
    shard = shard.withColumn("start", turn % F.col("n_blocks"))
    # The run of ``won`` blocks from ``start``, wrapped round the shard: one or two stretches of words.
    stop = F.col("start") + F.col("won")
    ends = {"a1": F.col("start"), "b1": F.least(stop, F.col("n_blocks")),
            "a2": F.lit(0), "b2": F.greatest(stop - F.col("n_blocks"), F.lit(0))}
    runs = shard.groupBy("skey").agg(F.collect_list(F.struct(
        *(((F.col("first") + at) * block).cast("long").alias(name) for name, at in ends.items()))).alias("runs"))
    plan = goal.join(runs, "skey", "left").select("skey", F.col("size").alias("source_size"), "target", "whole", "runs")

    # Each document's place on its source's axis, then its overlap with its source's runs (16 shards at most).
    placed = Window.partitionBy("skey", "slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("slice", in_slice).withColumn("inner", F.coalesce(F.sum("size").over(placed), F.lit(0)))
    rows = rows.join(slices.select("skey", "slice", "base"), ["skey", "slice"]).join(written(plan, "plan"), "skey")
    rows = rows.withColumn("lo", F.col("base") + F.col("inner")).withColumn("hi", F.col("lo") + F.col("size"))

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least("hi", b) - F.greatest("lo", a))

    part = F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + overlap(r["a1"], r["b1"]) + overlap(r["a2"], r["b2"])), F.lit(0))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + part).alias("taken"))


def repeat_taken(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` as mixed: each document as often as the mix takes it, rounded to whole texts.

    All columns stay as they were. Documents taken by less than half fall out;
    one taken 2.7 times comes three times.
    """
    taken = mix(docs, id_col=id_col, **options)
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    wanted = taken.where("size > 0").select(F.col("doc_id").alias("_id"), copies.alias("_copies"))
    wanted = written(wanted.groupBy("_id").agg(F.max("_copies").alias("_copies")).where("_copies > 0"), "copies")
    return (docs.join(small(wanted), F.col(id_col).cast("long").eqNullSafe(F.col("_id")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns))
