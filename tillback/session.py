"""Spark session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SPLIT_BYTES = 128 * 1024**2
LARGEST_SPLIT_BYTES = 1024**3
SHUFFLE_PARTITION_BYTES = 256 * 1024**2
MAX_SHUFFLE_BLOCKS = 2_000_000_000


def split_bytes(input_bytes: int) -> int:
    """Bytes of input for one task: 128 MB, and up to 1 GB for inputs with more than 100,000 such splits."""
    return min(LARGEST_SPLIT_BYTES, max(SPLIT_BYTES, input_bytes // 100_000))


def shuffle_partitions(input_bytes: int, moved_bytes: int | None = None, minimum: int = 200) -> int:
    """Initial shuffle partitions for the bytes that the largest shuffle moves; AQE merges small ones.

    A shuffle has as many blocks as map tasks times partitions, and the driver tracks them all; the
    count is cut so that they stay below two billion. 100 TB of input in splits of 1 GB give 93,133
    map tasks; a shuffle of a twentieth of it (facts cut to a few columns) gets 18,627 partitions of
    256 MB, one of everything 21,474 partitions of 4.7 GB, which executors sort in memory and spill.
    """
    moved = input_bytes // 20 if moved_bytes is None else moved_bytes
    tasks = max(1, -(-input_bytes // split_bytes(input_bytes)))
    return max(minimum, min(-(-moved // SHUFFLE_PARTITION_BYTES), MAX_SHUFFLE_BLOCKS // tasks))


def build_session(app_name: str = "tillback", *, input_bytes: int = 0, moved_bytes: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, ANSI casts, AQE with skew splitting, and size-checked broadcasts only.

    ``input_bytes`` is the size of the facts to be read, ``moved_bytes`` that of the largest shuffle;
    keyword settings use ``__`` for dots.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        # facts bucketed by sale id stay in place in the join on sale id and four more keys
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, moved_bytes)),
        "spark.sql.files.maxPartitionBytes": str(split_bytes(input_bytes)),
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
