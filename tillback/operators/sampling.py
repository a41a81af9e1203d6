"""Random draws that depend only on (seed, label, key), and exact samples built on them.

A draw is a hash, so a task that is run again, or a plan partitioned differently, gives the same
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 16_384


def uniform(seed: int, label: str, key: str) -> str:
    """SQL text of a number in [0, 1): 52 bits of a digest, which any engine can recompute."""
    digest = f"md5(concat_ws('|', '{seed}', '{label}', cast({key} as string)))"
    return f"(cast(conv(substr({digest}, 1, 13), 16, 10) as double) / 4503599627370496D)"


def sample_exact(df: DataFrame, key: str, count, *, seed: int, label: str, weight: str = "1.0D") -> DataFrame:
    """Exactly ``count`` rows (or all, if fewer) without replacement, drawn by weight.

    Every row gets an exponential key with its weight as rate, and the smallest keys win. Keys are
    counted in ordered buckets of equal width on a logarithmic scale, whatever the size of the
    weights; whole buckets below the limit are taken by a filter, and only the bucket at the limit,
    which holds about 0.002 % of the rows, is ranked. ``count`` is a number or a scalar column. ``df`` is read more
    than once, so it should be a stored table.
    """
    arrival = f"-ln(greatest({uniform(seed, label, key)}, 1.0E-18D)) / ({weight})"
    keyed = df.withColumn("_arrival", F.expr(arrival)).withColumn(
        "_bucket", F.expr(f"cast(floor({BUCKETS_PER_OCTAVE} * log2(_arrival)) as bigint)")
    )
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    through = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    limit = count if not isinstance(count, int) else F.lit(count)
    reached = sizes.withColumn("_before", F.sum("_n").over(through) - F.col("_n")).filter(F.col("_before") < limit)
    last_bucket = reached.agg(F.max(F.struct("_bucket", "_before"))).scalar()
    edge, taken = last_bucket["_bucket"], last_bucket["_before"]
    inner = keyed.filter(F.col("_bucket") < edge)
    at_edge = keyed.filter(F.col("_bucket") == edge).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy("_arrival", key))
    )
    last = at_edge.filter(F.col("_rank") <= limit - taken).drop("_rank")
    return inner.unionByName(last).drop("_arrival", "_bucket")
