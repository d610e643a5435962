"""Stored Bloom filters of keys, so that a load whose keys ranges cannot tell apart opens only the days that hold some.

A filter belongs to a load and an event date. It is cut into blocks of 32,768 bits, one row each; a key has all its bits
in one block, so asking a filter is an equality on the block and never moves the rest. The number of blocks is a power of
two (its exponent is the ``level``) that leaves at most 2,048 keys to a block on average: about one in four hundred
unknown keys passes a filter, and a stored key always does.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 15
KEYS_PER_BLOCK = 2048
BITS_PER_KEY = 4
BLOCK = ["level", "block"]


def level_for(keys: Column) -> Column:
    """The exponent of the number of blocks for so many keys."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(keys, F.lit(1)) / KEYS_PER_BLOCK))).cast("int")


def block_of(key: Column, level: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)


def places_of(key: Column) -> Column:
    """The bits of a key in its block: four slices of a hash that is not the block's."""
    other = F.xxhash64(key, F.lit("place"))
    return F.array(*[F.shiftrightunsigned(other, BLOCK_BITS * n).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for n in range(BITS_PER_KEY)])


def holds(bits: Column, place: Column) -> Column:
    """Whether a block has the bit at ``place``, in the byte order of ``bitmap_construct_agg``."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def key_filters(keys: DataFrame, sizes: DataFrame, key: str, day: str = "event_date") -> DataFrame:
    """Blocks of the filters of ``keys``, one filter per ``day``; rows without a key are left out.

    ``sizes`` tells the number of keys of each day as ``keys``, one row per calendar day. Bits are set in the map tasks
    first, so a key that holds a third of all rows costs one block per task.
    """
    levels = sizes.select(day, level_for(F.col("keys")).alias("level"))
    placed = keys.filter(F.col(key).isNotNull()).join(F.broadcast(levels), day).select(
        day, "level", block_of(F.col(key), F.col("level")).alias("block"), F.explode(places_of(F.col(key))).alias("place")
    )
    return placed.groupBy(day, *BLOCK).agg(F.bitmap_construct_agg("place").alias("bits"))


def possible_days(keys: DataFrame, filters: DataFrame, key: str, levels: list[int], day: str = "event_date") -> DataFrame:
    """Each key with every day whose filter it passes: all days that hold it, and few others.

    ``levels`` are the levels found in ``filters``, a number for each power of two. A key meets a block only where both
    numbers agree; blocks that no key asks for are not moved if the keys are few enough to be broadcast.
    """
    asked = keys.select(key).distinct().withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
    asked = asked.withColumn("block", block_of(F.col(key), F.col("level")))
    passed = F.forall(places_of(F.col(key)), lambda place: holds(F.col("bits"), place))
    return filters.select(day, *BLOCK, "bits").join(asked, BLOCK).filter(passed).select(key, day).distinct()


def passed_days(keys: DataFrame, filters: DataFrame, key: str, levels: list[int], day: str = "event_date") -> DataFrame:
    """The days whose own filters at least one of their own keys passes: ``keys`` tells each key's ``day``, so a key is asked
    of one day and not of all."""
    level, place = F.explode(F.array(*[F.lit(n) for n in levels])), places_of(F.col(key))
    asked = keys.select(day, key).distinct().withColumn("places", place).withColumn("level", level)
    asked = asked.withColumn("block", block_of(F.col(key), F.col("level"))).drop(key)
    passed = F.forall("places", lambda place: holds(F.col("bits"), place))
    return filters.select(day, *BLOCK, "bits").join(asked, [day, *BLOCK]).filter(passed).select(day).distinct()


def some_keys(keys: DataFrame, key: str, rows: int, most: int) -> DataFrame:
    """About ``most`` of the ``rows`` keys, by a hash of theirs."""
    return keys.filter(F.pmod(F.xxhash64(key, F.lit("some")), F.lit(max(1, rows // most))) == 0)
