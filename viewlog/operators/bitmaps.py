"""Sets of small numbers as bitmaps: exact distinct counts that merge by OR.

A set is kept as 64-bit words: number ``n`` is bit ``n % 64`` of word
``n // 64``. Words are BIGINT, so ``bit_or`` over them is a hash aggregate with
a fixed-size buffer (no sort, no Expand), and two sets of the same key add up
exactly however they overlap, which a stored distinct count cannot. Sets of
values that are no numbers need a dictionary: ``new_codes`` gives each value
not yet known the next number, and known values keep theirs for good.

NULL numbers and values are in no set; a key without any has no word and
counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.session import written

#: Bits of a word.
WORD = 64


def bit(n: Column) -> Column:
    """A BIGINT with bit ``n`` (0 to 63) set; NULL for NULL."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def bits(n: Column) -> Column:
    """Aggregate: the set of numbers 0 to 63 as one word."""
    return F.coalesce(F.bit_or(bit(n)), F.lit(0).cast("bigint"))


def size(word: Column) -> Column:
    """Aggregate: how many numbers the words hold."""
    return F.coalesce(F.sum(F.bit_count(word)), F.lit(0)).cast("bigint")


def words(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``keys, word, bits``: the set of ``number`` (not negative) for each key."""
    n = F.col(number)
    return (df.where(n.isNotNull()).select(*keys, F.floor(n / WORD).cast("bigint").alias("word"), bit(n % WORD).alias("bit"))
              .groupBy(*keys, "word").agg(F.bit_or("bit").alias("bits")))


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, word, bits``: the union of the sets of each key, whatever finer key they had."""
    return sets.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def counts(sets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``keys, name``: the size of the union of each key's sets."""
    return merged(sets, keys).groupBy(*keys).agg(size(F.col("bits")).alias(name))


def new_codes(values: DataFrame, known: DataFrame, value: str = "value") -> DataFrame:
    """``value, code``: the next free numbers for values that ``known`` (``value, code``) lacks, in value order.

    Values are sorted over range partitions; a value's number is its place in
    its partition and the rows before that partition, so no task sees them all.
    """
    fresh = (values.select(F.col(value).alias("value")).where("value is not null").distinct()
             .join(known.select("value"), "value", "left_anti"))
    placed = written(fresh.repartitionByRange("value").sortWithinPartitions("value")
                     .select("value", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part")), "codes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = (placed.groupBy("part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "first", "before"))
    start = F.coalesce(known.select(F.max("code")).scalar() + 1, F.lit(0))
    return placed.join(F.broadcast(parts), "part").select(
        "value", (F.col("row") - F.col("first") + F.col("before") + start).cast("bigint").alias("code"))
