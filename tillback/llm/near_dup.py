"""Near-duplicate documents: word-shingle MinHash signatures joined under a Hamming distance.

A signature has ``symbols`` values of ``bits`` bits (b-bit MinHash). Its Hamming distance is the
number of values in which two signatures differ. The signature is split into ``chunks``; by the
pigeonhole principle two signatures within ``chunks * (errors + 1) - 1`` have a chunk with at most
``errors`` differing values, so both share one of the keys that leave ``errors`` values of a chunk
out. All pairs within that distance (11 of 24 by default) become candidates; every candidate that
is needed for the components is confirmed on the full shingle sets. At a similarity of exactly 0.8
a pair shares no key with a chance of 0.00004; other links of the same group usually join it still.

Rows with equal sets are one node, named by a number of its own, and rows are told apart by their id
and a hash of their text, so rows that share an id may lie in different groups.

Defined results: a text without words has an empty set and is linked with nothing. Fewer words than
a shingle form one shingle. Rows without an id are never linked and always kept. A component's id is the smallest of
its rows; of rows that share this id the one with the smallest text hash is kept, and equal rows are kept or
not alike. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.llm.frames import by_slices, keyed_texts, lists, stored, visible
from tillback.llm.graph import linked
from tillback.llm.words import U64, Words, constants, mixed


@dataclass(frozen=True)
class NearDup:
    """Parameters of the join."""

    words: int = 5
    percent: int = 80
    symbols: int = 24
    bits: int = 16
    chunks: int = 6
    errors: int = 1

    @property
    def guaranteed_distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    def key_columns(self) -> list[tuple[int, ...]]:
        """Signature columns of every key."""
        width = self.symbols // self.chunks
        groups = [range(i * width, (i + 1) * width) for i in range(self.chunks)]
        return [kept for group in groups for kept in combinations(group, width - self.errors)]


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and where each text begins."""
    words = Words(column, lower=True)
    at, hashes = words.windows(size, seed=21)
    counts = np.diff(words.first)
    begins = np.searchsorted(at, words.first)
    sets = [np.unique(hashes[begins[i] : begins[i + 1]]) for i in range(len(counts))]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        sets[i] = mixed(np.array([(own * constants(len(own), 22)).sum() + U64(len(own))], U64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), offsets


def signatures(flat: np.ndarray, offsets: np.ndarray, p: NearDup) -> np.ndarray:
    """One row of b-bit MinHash values per non-empty set."""
    begins = offsets[:-1][np.diff(offsets) > 0]
    if not len(begins):
        return np.zeros((0, p.symbols), U64)
    columns = []
    for factor in constants(p.symbols, 23):
        permuted = flat * factor
        permuted ^= permuted >> U64(29)
        permuted *= factor
        columns.append(mixed(np.minimum.reduceat(permuted, begins)) >> U64(64 - p.bits))
    return np.stack(columns, axis=1)


def join_keys(signature: np.ndarray, p: NearDup) -> np.ndarray:
    keys = []
    for number, kept in enumerate(p.key_columns()):
        key = np.full(len(signature), number + 1, U64)
        for column in kept:
            key = mixed((key << U64(1)) ^ mixed(signature[:, column] + key))
        keys.append(key)
    return np.stack(keys, axis=1)


def _described(p: NearDup):
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = shingle_sets(part.column("text"), p.words)
        sizes = np.diff(offsets)
        full = sizes > 0
        digests = np.zeros((2, len(sizes)), U64)
        if full.any():
            for k, salt in enumerate(constants(2, 24)):
                digests[k, full] = np.add.reduceat(mixed(flat ^ salt), offsets[:-1][full])
        keys = join_keys(signatures(flat, offsets, p), p) if full.any() else np.zeros((0, 0), U64)
        starts = np.concatenate([[0], np.cumsum(np.where(full, keys.shape[1], 0))])
        return pa.record_batch({
            "doc_id": part.column("doc_id"), "t": part.column("t"), "n_shingles": pa.array(sizes, pa.int64()),
            "d1": digests[0].view(np.int64), "d2": digests[1].view(np.int64),
            "keys": lists(keys.reshape(-1).view(np.int64), starts, pa.int64()),
        })

    return by_slices(work)


def _sets(p: NearDup):
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = shingle_sets(part.column("text"), p.words)
        return pa.record_batch({"id": part.column("doc_id"), "shingles": lists(flat.view(np.int64), offsets, pa.int64())})

    return by_slices(work)


ROW = "doc_id bigint, t bigint"


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``t``, a hash of the text; a null text is an empty one."""
    return keyed_texts(docs).withColumn("t", F.xxhash64("text"))


def components_of(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """doc_id, t (a hash of the text), n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    texts = _named(docs)
    schema = f"{ROW}, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>"
    described = stored(texts.mapInArrow(_described(p), schema), "near-described")
    usable = described.filter("n_shingles > 0 and doc_id is not null")
    # equal sets first: only one node for each set takes part in the join
    classes = usable.groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.min("keys").alias("keys"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "near-classes")
    members = classes.select(F.explode("keys").alias("key"), F.col("class").alias("id"))

    def prepare(ids: DataFrame) -> DataFrame:
        wanted = classes.join(ids.withColumnRenamed("id", "class"), "class", "left_semi")
        wanted = wanted.select(F.col("rep.doc_id").alias("rep_id"), F.col("rep.t").alias("rep_t"), "class")
        rows = texts.join(wanted, (F.col("doc_id") == F.col("rep_id")) & (F.col("t") == F.col("rep_t")))
        rows = rows.select(F.col("class").alias("doc_id"), "text").dropDuplicates(["doc_id"])
        return stored(rows.mapInArrow(_sets(p), "id bigint, shingles array<bigint>"), "near-sets")

    rooted = linked(members, prepare, p.percent, "near").select(F.col("id").alias("class"), "root")
    placed = classes.select("class", "rep", "d1", "d2", "n_shingles").join(rooted, "class", "left").withColumn("root", F.coalesce("root", "class"))
    first = placed.groupBy("root").agg(F.min("rep").alias("first"))
    named = placed.join(first, "root").select("d1", "d2", "n_shingles", "first")
    rows = described.select("doc_id", "t", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    own = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    kept = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.t") == F.col("t"))
    return rows.select(
        "doc_id", "t", "n_shingles", F.when(own, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(own, kept).otherwise(True).alias("kept"),
    )


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    return components_of(docs, p).drop("t")


def without_near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The same columns, and one row of each group of near duplicates; rows without words or id stay."""
    found = stored(components_of(docs, p), "near-components")
    gone = found.filter(~F.col("kept")).select("doc_id", "t").distinct()
    # equal rows of one id are kept alike: all but one of them go as well
    equal = found.filter("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id", "t").count().filter("count > 1").select("doc_id", "t")
    name, rows = "_text_hash", visible(docs)
    while name in docs.columns:
        name = "_" + name
    rows = rows.withColumn(name, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))

    def beside(found: DataFrame, how: str, left: DataFrame) -> DataFrame:
        named = found.select(F.col("doc_id").alias("_gone_id"), F.col("t").alias("_gone_t"))
        return left.join(named, (F.col("doc_id") == F.col("_gone_id")) & (F.col(name) == F.col("_gone_t")), how)

    left = beside(gone, "left_anti", rows)
    if not equal.isEmpty():
        left = beside(equal, "left_anti", left).unionByName(beside(equal, "left_semi", left).dropDuplicates(["doc_id", name]))
    return left.select(*[F.col(f"`{column}`") for column in docs.columns])
