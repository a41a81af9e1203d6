"""Distinct counts that are prepared once: marks at the first row of an id within each of several keys.

The sum of a key's marks over any group of that key is its number of distinct ids, so aggregates over
stored rows move partial sums instead of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillback.sources.scratch import settled

FIRST_MARKS = "first_marks"
BROADCAST_IDS = 1_048_576  # bound of repeated hashes that all executors get


def marked_count(number: int) -> Column:
    """Distinct ids of a group by the key with this number."""
    return F.sum(F.shiftright(FIRST_MARKS, number).bitwiseAND(1)).cast("bigint")


def repeated_rows(df: DataFrame, identity: str) -> DataFrame | None:
    """Rows of a stored frame whose id may stand in several rows; None if there are none.

    Hashes of ids are counted, so that ids are not moved; a hash that two ids share gives rows too many, never too few.
    """
    of = F.xxhash64(identity)
    known = df.filter(F.col(identity).isNotNull())
    several = known.groupBy(of.alias("_several")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_several")
    several = settled(several, "repeated-hashes")
    ids = several.count()
    if not ids:
        return None
    picked = F.broadcast(several) if ids <= BROADCAST_IDS else several
    return settled(known.join(picked, of == F.col("_several"), "left_semi"), "repeated-rows")


def repeats_by(rows: DataFrame, key: str, identity: str) -> DataFrame:
    """(key, _over): by how much rows with an id outnumber the distinct ids of a key, for keys where they do."""
    counts = rows.groupBy(key, identity).agg((F.count("*") - 1).alias("_over")).filter("_over > 0")
    return counts.groupBy(F.col(key).alias("_key")).agg(F.sum("_over").alias("_over"))


def with_first_marks(df: DataFrame, identity: str, keys: dict[str, str]) -> DataFrame:
    """The same rows with a whole number ``first_marks``: bit k is set on one row of every id and value of key k.

    ``keys`` maps names to SQL text; a null value is a value. Rows without an id have no marks. Where
    an id stands once, its row has all marks. Only rows of repeated ids are looked at further: the
    row with the smallest number is marked, found by partial minima, so an id with very many rows is no
    hot key.
    """
    rows = settled(df.withColumn("_row", F.monotonically_increasing_id()), "marked-rows")
    several = rows.filter(F.col(identity).isNotNull()).groupBy(F.col(identity).alias("_several")).agg(F.count("*").alias("_n"))
    several = several.filter("_n > 1").select("_several")
    repeated = settled(rows.join(several, F.col(identity) == F.col("_several"), "left_semi").select(
        "_row", F.col(identity).alias("_id"),
        F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"cast({text} as string)").alias("v")) for k, text in enumerate(keys.values())]).alias("_keys"),
    ), "repeated-ids")
    firsts = repeated.select("_row", "_id", F.explode("_keys").alias("key")).groupBy("_id", "key").agg(F.min("_row").alias("_row"))
    marks = firsts.groupBy("_row").agg(F.sum(F.expr("shiftleft(1, key.k)")).cast("int").alias("_marks"))
    some = repeated.select("_row").join(marks, "_row", "left").select("_row", F.coalesce("_marks", F.lit(0)).alias("_marks"))
    marked = rows.join(some, "_row", "left")
    every = F.when(F.col(identity).isNull(), 0).otherwise(F.coalesce("_marks", F.lit((1 << len(keys)) - 1)))
    return marked.withColumn(FIRST_MARKS, every.cast("int")).drop("_row", "_marks")
