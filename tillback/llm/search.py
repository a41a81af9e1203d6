"""Exact top-k search by inner product with vector-approximation files.

Vectors are stored in pages of quantised cells, one byte a component. Blocks of queries scan the
cells: they give an upper and a lower bound of every product, and a vector stays a candidate of a
query only while its upper bound reaches the k-th best lower bound, first within the pages of a group, then
over all pages. Exact vectors are then read in the order of their bounds: the k most promising first;
their k-th product is the limit that the rest must reach to be read at all.

Products are those of whole numbers floor(scale * x). Groups of pages and of blocks meet by the numbers of
their groups, so neither side is broadcast, a page is not moved for every block, and a task holds one group of each.

Bounds are taken in floating point, widened by what rounding may lose, and scores in whole numbers of
38 digits, so large components are as exact as small ones.

Defined results: vectors that are null, or hold a null or non-finite component, take no part, nor do
rows without an id, nor vectors with a component that is no 62-bit number after scaling. A score
beyond 64 bits is given as the nearest 64-bit number, but ranked by its value. Only vectors of equal
length meet. A query does not meet rows with its own id. Equal rows are candidates of their own; of
several queries with one id, the one with the smallest vector counts. Ties go to the smaller id. Extra columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillback.llm.frames import stored, visible


@dataclass(frozen=True)
class Search:
    """Parameters of pages, blocks and quantisation."""

    k: int = 5
    scale: int = 256
    page: int = 4096
    block: int = 1024
    cells: int = 256
    pages_together: int = 32
    blocks_together: int = 8


def whole_numbers(vectors: DataFrame, p: Search) -> DataFrame:
    """(vec_id, x): vectors as arrays of whole numbers; only those that take part."""
    bad = "exists(embedding, v -> v is null or isnan(v) or abs(cast(v as double)) >= {0:.1f}D)".format(float(2**62) / p.scale)
    usable = visible(vectors).filter("vec_id is not null and embedding is not null").filter(~F.expr(bad))
    scaled = F.expr(f"transform(embedding, v -> cast(floor({p.scale} * cast(v as double)) as bigint))")
    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors in groups of at most ``rows`` vectors of one length."""
    for batch in batches:
        sizes = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            chosen = np.flatnonzero(sizes == size)
            flat = batch.column("x").take(pa.array(chosen)).flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(len(chosen), size)
            for k in range(0, len(chosen), rows):
                yield ids[chosen[k : k + rows]], matrix[k : k + rows]


PAGES = "page bigint, size int, ids binary, low binary, width binary, cells binary"
BLOCKS = "block bigint, size int, ids binary, x binary"


def approximations(numbers: DataFrame, p: Search) -> DataFrame:
    """Pages of quantised vectors: per component the lowest value, the width of a cell, and a byte a vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, x in _matrices(batches, p.page):
            low = x.min(axis=0, initial=2**62)
            width = (x.max(axis=0, initial=-(2**62)) - low) // p.cells + 1
            cells = ((x - low) // width).astype(np.uint8)
            yield _binary_row(PAGES, number, x.shape[1], ids, low, width, cells)
            number += 1

    return numbers.mapInArrow(run, PAGES)


def query_blocks(queries: DataFrame, p: Search) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, x in _matrices(batches, p.block):
            yield _binary_row(BLOCKS, number, x.shape[1], ids, x)
            number += 1

    return queries.mapInArrow(run, BLOCKS)


def _binary_row(schema: str, number: int, size: int, *parts: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    values = [pa.array([number], pa.int64()), pa.array([size], pa.int32())]
    return pa.record_batch(dict(zip(names, values + [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts])))


BOUNDS = "query_id bigint, vec_id bigint, lower double, upper double"


class Held:
    """A block's queries with the limits that the pages seen so far set: a query's k-th best lower bound."""

    def __init__(self, block: dict, k: int):
        self.size, self.k = block["size"], k
        self.ids = np.frombuffer(block["ids"], np.int64)
        self.x = np.frombuffer(block["x"], np.int64).reshape(len(self.ids), self.size).astype(np.float64)
        self.narrow, self.most = self.x.astype(np.float32), np.abs(self.x).max(initial=0)
        self.best = np.full((len(self.ids), k), -np.inf)
        self.found: list[tuple[np.ndarray, ...]] = []

    def read(self, page: dict) -> None:
        """Find the candidates of the queries in a page, with bounds of their products."""
        size, x = self.size, self.x
        ids = np.frombuffer(page["ids"], np.int64)
        low, width = np.frombuffer(page["low"], np.int64), np.frombuffer(page["width"], np.int64)
        cells = np.frombuffer(page["cells"], np.uint8).reshape(len(ids), size)
        corners = (low + cells.astype(np.int64) * width).T.astype(np.float64)
        spread = (width - 1).astype(np.float64)
        most = size * self.most * np.abs(corners).max(initial=0)
        # sums of whole numbers are exact below 2**24 in 32 bits, below 2**53 in 64 bits
        base = self.narrow @ corners.astype(np.float32) if max(most, np.abs(corners).max(initial=0)) < 2**24 else x @ corners
        below, above = (np.minimum(x, 0) @ spread)[:, None], (np.maximum(x, 0) @ spread)[:, None]
        slack = np.zeros((1, 1))
        if most + size * self.most * spread.max(initial=0) >= 2**52:
            # beyond, rounding loses a share of the sum of sizes
            slack = size * 2.0**-50 * (np.abs(x) @ (np.abs(corners) + spread[:, None]))
        # a product may reach the limit if its sum does, less what the cells' widths may add; own rows leave afterwards
        limit = np.maximum(self.best[:, :1], self._limit(base, below - slack, ids))
        q, v = np.nonzero(base >= limit - above - slack)
        other = self.ids[q] != ids[v]
        q, v = q[other], v[other]
        sums, lost = base[q, v].astype(np.float64), np.broadcast_to(slack, base.shape)[q, v]
        lower, upper = sums + below[q, 0] - lost, sums + above[q, 0] + lost
        self._learn(q, lower)
        self.found.append((q, ids[v], lower, upper))

    def candidates(self) -> pa.Table:
        """What is still a candidate when all pages have been read."""
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        q, ids, lower, upper = (np.concatenate(parts) for parts in zip(none, *self.found))
        left = upper >= self.best[q, 0]
        return pa.table({"query_id": self.ids[q[left]], "vec_id": ids[left], "lower": lower[left], "upper": upper[left]})

    def _limit(self, base: np.ndarray, shift: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The k-th best lower bound within a page, own rows apart; only queries that lack a limit are looked at."""
        found = np.full((len(self.ids), 1), -np.inf)
        lacking = np.flatnonzero(np.isneginf(self.best[:, 0]))
        if len(lacking) and len(ids) >= self.k:
            lower = base[lacking] + shift[lacking]
            lower[self.ids[lacking][:, None] == ids[None]] = -np.inf
            found[lacking, 0] = np.partition(lower, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
        return found

    def _learn(self, q: np.ndarray, lower: np.ndarray) -> None:
        """Take lower bounds of new candidates into the best k; the first column is the k-th best."""
        order = np.lexsort((-lower, q))
        q, lower = q[order], lower[order]
        first = np.searchsorted(q, q)
        place = np.arange(len(q)) - first
        new = np.full((len(self.ids), self.k), -np.inf)
        kept = place < self.k
        new[q[kept], place[kept]] = lower[kept]
        self.best = np.sort(np.concatenate([self.best, new], axis=1), axis=1)[:, -self.k :]


NOTHING = Held({"size": 0, "ids": b"", "x": b""}, 1)
# Groups of pages that a small table is split into, and tasks that groups are dealt to at most.
LEAST_GROUPS, MOST_TASKS = 16, 20_000


def candidates(pages: DataFrame, blocks: DataFrame, p: Search) -> DataFrame:
    """Bounds of all vectors that may be among a query's k best, by the pages of its group.

    Pages and blocks meet in groups, so that a page moves once for ``blocks_together`` blocks and a block once for
    ``pages_together`` pages (fewer if there are few). Within a group each page is held against the limits that the pages
    before it have set.
    """
    counts = pages.agg(F.count("*")).first()[0], blocks.agg(F.count("*")).first()[0]
    groups = max(1, -(-counts[0] // p.pages_together), min(counts[0], LEAST_GROUPS))
    rows = max(1, -(-counts[1] // p.blocks_together))
    left = pages.withColumn("g", F.pmod(F.xxhash64("page"), F.lit(groups))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<bigint>")))
    dealt = blocks.withColumn("b", F.pmod(F.xxhash64("block"), F.lit(rows)))
    right = dealt.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))

    def run(of_group: pa.Table, against: pa.Table) -> pa.Table:
        held = [Held(block, p.k) for block in against.select(["size", "ids", "x"]).to_pylist()]
        for k in range(of_group.num_rows):
            page = of_group.slice(k, 1).to_pylist()[0]
            for queries in held:
                if queries.size == page["size"]:
                    queries.read(page)
        return pa.concat_tables([queries.candidates() for queries in [*held, NOTHING]])

    # as many tasks as the work asks for, which the few bytes moved don't tell
    tasks = min(2 * groups * rows, MOST_TASKS)
    left, right = (frame.repartition(tasks, "g", "b").groupBy("g", "b") for frame in (left, right))
    return left.cogroup(right).applyInArrow(run, BOUNDS)


def _exact(pairs: DataFrame, numbers: DataFrame, queries: DataFrame) -> DataFrame:
    """Products of (query_id, vec_id) from the exact vectors."""
    left = queries.select(F.col("vec_id").alias("query_id"), F.col("x").alias("q"))
    wide = "cast(a as decimal(19,0)) * cast(b as decimal(19,0))"
    product = F.expr(f"aggregate(zip_with(x, q, (a, b) -> {wide}), cast(0 as decimal(38,0)), (total, v) -> cast(total + v as decimal(38,0)))")
    read = pairs.join(numbers, "vec_id").join(left, "query_id").filter("size(x) = size(q)")
    return read.select("query_id", "vec_id", product.alias("score"))


def top_k(vectors: DataFrame, is_query, p: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that the condition names a query."""
    numbers = stored(whole_numbers(vectors, p), "search-numbers")
    queries = numbers.filter(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    pages = stored(approximations(numbers, p), "search-pages")
    blocks = stored(query_blocks(queries, p), "search-blocks")
    by_query = Window.partitionBy("query_id")
    found = candidates(pages, blocks, p)
    place = F.row_number().over(by_query.orderBy(F.desc("lower"), "vec_id"))
    limit = F.min(F.when(F.col("place") <= p.k, F.col("lower"))).over(by_query)
    hopeful = found.withColumn("place", place).withColumn("limit", limit).filter("upper >= limit")
    order = F.row_number().over(by_query.orderBy(F.desc("upper"), "vec_id"))
    hopeful = stored(hopeful.select("query_id", "vec_id", "upper", order.alias("turn")), "search-hopeful")
    first = stored(_exact(hopeful.filter(F.col("turn") <= p.k).select("query_id", "vec_id").distinct(), numbers, queries), "search-first")
    certain = first.groupBy("query_id").agg(F.min("score").cast("double").alias("certain"))
    # a bound and a score are compared as floating point numbers, so a bound just below the score counts too
    enough = F.col("upper") >= F.col("certain") - F.abs("certain") * 2.0**-50
    later = hopeful.filter(F.col("turn") > p.k).join(certain, "query_id").filter(enough).select("query_id", "vec_id")
    later = later.join(first, ["query_id", "vec_id"], "left_anti").distinct()
    scored = first.unionByName(_exact(later, numbers, queries))
    rank = F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id")).alias("rank")
    ranked = scored.select("query_id", rank, "vec_id", "score").filter(F.col("rank") <= p.k)
    nearest = F.least(F.greatest("score", F.lit(-(2**63)).cast("decimal(19,0)")), F.lit(2**63 - 1).cast("decimal(19,0)"))
    return ranked.withColumn("score", nearest.cast("bigint"))
