"""Joins and merges shared by the plans.

A lookup whose rows have been counted is broadcast up to ``BROADCAST_BYTES``, so that wide facts do not move
for it. Any other join carries no hint: Spark broadcasts a side only when its estimated size is under the
session threshold, and otherwise uses a sort-merge join whose hot keys AQE splits. Where facts may be stored on the
way, ``attach_in_chunks`` broadcasts larger lookups a chunk at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillback.sources.scratch import delete_folder, shared_folder, write_rows

# Bound of a counted lookup that every executor gets whole, and the bytes that a row and each of its values take there.
BROADCAST_BYTES = 128 * 1024**2
ROW_BYTES, VALUE_BYTES = 16, 24
# Lookups of more chunks of that size than this are joined by a sort-merge join.
MAX_CHUNKS = 64


def chunk_count(rows: int, attributes: dict[str, str]) -> int:
    """Chunks of at most ``BROADCAST_BYTES`` that a counted lookup falls into, with its key and these attributes."""
    return max(1, -(-rows * (ROW_BYTES + VALUE_BYTES * (1 + len(attributes))) // BROADCAST_BYTES))


def attach(
    facts: DataFrame, lookup: DataFrame, key: str, attributes: dict[str, str], on: str | None = None, rows: int | None = None
) -> DataFrame:
    """Left join of ``lookup`` columns (output name -> lookup column) on its ``key``.

    ``on`` names the fact column when it is called differently; ``rows`` is the number of lookup rows, if known.

    Rows without a match keep nulls, and a key repeated in ``lookup`` repeats the fact row.
    """
    picked = lookup.select(
        F.col(key).alias("_lookup_key"),
        *[F.col(source).alias(name) for name, source in attributes.items()],
    )
    if rows is not None and chunk_count(rows, attributes) == 1:
        picked = F.broadcast(picked)
    joined = facts.join(picked, facts[on or key] == picked["_lookup_key"], "left")
    return joined.drop("_lookup_key")


def attach_in_chunks(facts: DataFrame, lookups: list[tuple[DataFrame, str, dict[str, str], int]]) -> DataFrame:
    """The rows that ``attach`` gives for each (lookup, key, attributes, rows) in turn, stored, without a shuffle of the facts.

    Lookup and facts are stored by a hash of the key in as many parts as the lookup has chunks, and every chunk is
    broadcast to the facts of its part. Stored columns take less than half of what the same rows take in a shuffle, a hot key or many
    missing ones need no task of their own, and a part is deleted as soon as its rows have got their attributes. A lookup must
    have its key in the type of the facts' key.
    """
    spark, label = facts.sparkSession, "facts-by-chunk"
    parts = [(facts, ())]
    for lookup, key, attributes, rows in lookups:
        chunks = chunk_count(rows, attributes)
        chunk = F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int").alias("_chunk")
        dealt, known = shared_folder(spark, label), shared_folder(spark, "lookup-by-chunk")
        picked = lookup.select(key, *dict.fromkeys(attributes.values()))
        write_rows(picked.select("*", chunk), known, "_chunk")
        schema = parts[0][0].schema
        for part, stored_at in parts:
            write_rows(part.select("*", chunk), dealt, "_chunk")
            for folder in stored_at:
                delete_folder(spark, folder)
        placed, found = (
            spark.read.schema(T.StructType([*of.fields, T.StructField("_chunk", T.IntegerType())])).parquet(path)
            for of, path in ((schema, dealt), (picked.schema, known))
        )
        parts = []
        for k in range(chunks):
            own, met = (frame.filter(F.col("_chunk") == k).drop("_chunk") for frame in (placed, found))
            parts.append((attach(own, F.broadcast(met), key, attributes), [f"{path}/_chunk={k}" for path in (dealt, known)]))
    whole, schema = shared_folder(spark, "facts-with-context"), parts[0][0].schema
    for part, stored_at in parts:
        write_rows(part, whole)
        for folder in stored_at:
            delete_folder(spark, folder)
    return spark.read.schema(schema).parquet(whole)


# Bound of the words of 64 bits that tell which keys may be met: all executors get them.
MET_WORDS = 1_048_576


def with_met(facts: DataFrame, names: list[str], others: DataFrame, words: int = MET_WORDS) -> DataFrame:
    """``facts`` with ``_met``: false where ``others`` surely has no row with the same values of ``names``.

    Every row of ``others`` sets the bit that its values hash to, of 64 in each of ``words`` words. Facts whose bit is
    not set need not be moved to be joined; a bit set by other values costs a move and changes no result.
    """
    bit = F.pmod(F.xxhash64(*names), F.lit(64 * words))
    taken = others.select(bit.alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word"))
    taken = taken.agg(F.expr("bit_or(shiftleft(1L, cast(_bit & 63 as int)))").alias("_bits"))
    found = facts.withColumn("_bit", bit).join(F.broadcast(taken), F.expr("shiftright(_bit, 6) = _word"), "left")
    met = F.expr("coalesce(shiftrightunsigned(_bits, cast(_bit & 63 as int)) & 1 = 1, false)")
    return found.withColumn("_met", met).drop("_bit", "_word", "_bits")


def likely_met(facts: DataFrame, name: str, others: DataFrame) -> DataFrame:
    """The facts that a join with ``others`` on this column may need; both should be stored, as ``others`` is read once more."""
    return with_met(facts, [name], others).filter("_met").drop("_met")


# Bounds of what a split join takes from its keys: slots of the filter, and how frequent a key must be to be split.
FILTER_SLOTS = 1_048_576
HEAVY_SHARE = 100
SALTS = 64


def attach_split(
    facts: DataFrame, lookup: DataFrame, key: str, attributes: dict[str, str], *,
    heavy_share: int = HEAVY_SHARE, salts: int = SALTS,
) -> DataFrame:
    """The rows of ``attach`` for facts whose key is often missing, unknown or always the same.

    Three parts of the facts are joined apart and put together again, so ``facts`` should be stored:

    * rows without a key, or with one that the lookup surely lacks, have no match and are not moved.
      A key is surely unknown if its hash falls into a slot that no lookup key has; of the slots, at most
      ``FILTER_SLOTS`` numbers, the session may broadcast as many as its threshold allows;
    * keys that hold more than one in ``heavy_share`` of all rows (so fewer than ``heavy_share`` keys)
      are spread over ``salts`` tasks each, and their lookup rows are repeated for every salt;
    * all others are joined by key.
    """
    picked = lookup.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_lookup_key"), *[F.col(source).alias(name) for name, source in attributes.items()]
    )
    slot = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(FILTER_SLOTS)).cast("int")
    taken = picked.select(F.pmod(F.xxhash64(F.col("_lookup_key").cast("string")), F.lit(FILTER_SLOTS)).cast("int").alias("_slot")).distinct()
    sized = facts.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_heavy_key")).agg(F.count("*").alias("_n"))
    total = facts.agg(F.count("*")).first()[0]
    heavy = [row[0] for row in sized.filter(F.col("_n") * heavy_share > total).select("_heavy_key").collect()]

    is_heavy = F.col(key).isin(heavy) if heavy else F.lit(False)
    without = facts.filter(F.col(key).isNull())
    light = facts.filter(F.col(key).isNotNull() & ~is_heavy).withColumn("_slot", slot)
    unknown = light.join(taken, "_slot", "left_anti").drop("_slot")
    likely = light.join(taken, "_slot", "left_semi").drop("_slot")
    joined = likely.join(picked, likely[key] == picked["_lookup_key"], "left").drop("_lookup_key")
    parts = [joined]
    if heavy:
        salted = facts.filter(is_heavy).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        repeated = picked.filter(F.col("_lookup_key").isin(heavy)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = salted.join(repeated, (salted[key] == repeated["_lookup_key"]) & (salted["_salt"] == repeated["_salt"]), "left")
        parts.append(met.drop("_lookup_key", "_salt"))
    none = [F.lit(None).cast(picked.schema[name].dataType).alias(name) for name in attributes]
    parts += [part.select("*", *none) for part in (without, unknown)]
    return reduce(DataFrame.unionByName, parts).select(*facts.columns, *attributes)


def totals_by_key(key: str, *sides: tuple[DataFrame, str, dict[str, Column]]) -> DataFrame:
    """Sums of several facts per key in one pass.

    Each side is (frame, its key column, measure name -> addend). The sides are stacked and summed
    together, so there is one small shuffle of partial sums and no join between the facts; a hot
    key is reduced inside every map task before it moves. A measure without any value is null.
    """
    stacked = [
        frame.select(F.col(source).alias(key), *[addend.alias(name) for name, addend in measures.items()])
        for frame, source, measures in sides
    ]
    names = [name for _, _, measures in sides for name in measures]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), stacked)
    return rows.groupBy(key).agg(*[F.sum(name).alias(name) for name in names])


def full_merge(key: str, *frames: DataFrame, zeros: list[str]) -> DataFrame:
    """Full outer join of frames on one key, with absent measures filled with zero.

    Keys that are null never match, so every side keeps its own null-key row.
    """
    merged = reduce(lambda left, right: left.join(right, on=key, how="full"), frames)
    return merged.fillna(0, subset=zeros)
