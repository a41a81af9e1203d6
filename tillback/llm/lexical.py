"""Ranked lexical search over a length-stratified index: exact best documents of every query text.

A document's normaliser m is a whole number that depends on its length alone. Documents of equal m are
a stratum. The index holds documents with their query terms, dealt out and sorted by stratum; within a
stratum postings are put in order of term and tf, the number of occurrences. All documents of such a
group get the same impact from the term, which is computed once for the group.

Queries come in blocks of bounded size. A task goes through its strata, some at a time: the largest
impacts of a query's terms in a stratum add up to a bound of all scores there. Strata are visited in
the order of their bounds, and a query visits a stratum only while its bound reaches the k-th best
score that the query has found; elsewhere no document can be among its k best. A visited stratum's
postings are added up for all its documents at once. Every task returns its k best documents of each
query, of which the k best are the result.

Only occurrences of query terms are kept from the texts: a bit map of fixed size, made of the terms'
hashes, tells which words may be one. Terms are compared by a 64-bit hash. No step holds the postings
of a term, a stratum or a query in one task.

Defined results: a null text, or one without terms, counts for nothing and is never found. Every row
is a document of its own, also where rows share an id; ids that are null come last among equal
scores. Every query row with an id is a query of its own; one without terms finds nothing. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillback.llm.frames import by_slices, keyed_texts, lists, stored
from tillback.llm.words import NO_TERM, U64, Words

SLOT_BITS = 24  # the bit map has so many bits at most, whatever the number of query terms
BITS_OF_ROW = 32_768  # of one row of bitmap_construct_agg
PAIRS_OF_BLOCK = 100_000  # about so many pairs of query and term are sent to the tasks at once
POSTINGS_AT_ONCE = 1_000_000  # of the strata that a task puts in order together
SCORES_AT_ONCE = 2_000_000  # of queries times documents that are added up at once


@dataclass(frozen=True)
class Ranking:
    """Results per query, and the normaliser base - slope + slope * length / mean length."""

    k: int = 20
    base: int = 100
    slope: int = 25

    def normaliser(self, documents: int, terms: int):
        return F.lit(self.base - self.slope) + F.expr(f"({self.slope}L * n * {documents}L) div {max(terms, 1)}L")


def weight(documents: int):
    return F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("bigint")


def _counted(words: Words, chosen: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Distinct hashes of the chosen words of each text, and how often each occurs."""
    rows, hashes = words.rows[chosen], words.hashes[chosen]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(rows)))
    offsets = np.searchsorted(rows[begins], np.arange(len(words.first)))
    return lists(hashes[begins].view(np.int64), offsets, pa.int64()), lists(counts.astype(np.int32), offsets, pa.int32())


def _terms_of(may_matter=None):
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"), lower=True, gaps=NO_TERM)
        chosen = np.arange(len(words))
        if may_matter is not None:
            bits = np.frombuffer(may_matter.value, np.uint8)
            slot = words.hashes & U64((1 << SLOT_BITS) - 1)
            chosen = np.flatnonzero(bits[(slot >> U64(3)).astype(np.int64)] >> (slot & U64(7)).astype(np.uint8) & 1)
        terms, counts = _counted(words, chosen)
        return pa.record_batch({
            "id": part.column("id"), "n": pa.array(np.diff(words.first), pa.int64()), "terms": terms, "counts": counts,
        })

    return by_slices(work)


TERMS = "id bigint, n bigint, terms array<bigint>, counts array<int>"
INDEX = "row bigint, id bigint, m bigint, terms array<bigint>, counts array<int>"
FOUND = "item bigint, row bigint, id bigint, score bigint"


def bit_map(terms: DataFrame) -> bytes:
    """Bits of the slots that the given terms fall into: 2 MB, however many terms there are."""
    slot = F.expr(f"term & {(1 << SLOT_BITS) - 1}L") + 1
    rows = terms.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    found = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # 512 rows at most
    bits = bytearray((1 << SLOT_BITS) // 8)
    for row in found:
        begin = (row["bucket"] - 1) * BITS_OF_ROW // 8
        bits[begin : begin + BITS_OF_ROW // 8] = row["bits"]
    return bytes(bits)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number of their own, which holds as they are stored."""
    return rows.withColumn("row", F.monotonically_increasing_id())


def query_terms(queries: DataFrame, key: str) -> DataFrame:
    """(item, item_id, term, q): every query row's terms and how often each stands in it."""
    texts = keyed_texts(queries, key).filter(F.col(key).isNotNull()).withColumnRenamed(key, "id")
    made = stored(_numbered(texts.mapInArrow(_terms_of(), TERMS)), "lexical-queries")
    pair = F.explode(F.arrays_zip("terms", "counts")).alias("p")
    return made.select(F.col("row").alias("item"), F.col("id").alias("item_id"), pair).select(
        "item", "item_id", F.col("p.terms").alias("term"), F.col("p.counts").cast("bigint").alias("q")
    )


def stratified_index(docs: DataFrame, terms: DataFrame, p: Ranking) -> tuple[DataFrame, DataFrame]:
    """Documents with their query terms, dealt out and sorted by stratum, and (term, w): the weights of the terms."""
    may_matter = docs.sparkSession.sparkContext.broadcast(bit_map(terms))
    texts = keyed_texts(docs).withColumnRenamed("doc_id", "id")
    described = stored(_numbered(texts.mapInArrow(_terms_of(may_matter), TERMS)), "lexical-documents")
    documents, total = described.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    listed = described.filter(F.size("terms") > 0).withColumn("m", p.normaliser(documents, total))
    # a stratum with a third of all documents is cut by their numbers
    dealt = listed.select("row", "id", "m", "terms", "counts").repartitionByRange("m", "row").sortWithinPartitions("m")
    index = stored(dealt, "lexical-index")
    df = described.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = df.join(terms.select("term").distinct(), "term", "left_semi").select("term", weight(documents).alias("w"))
    return index, weights


@dataclass
class Block:
    """Some queries: their terms in order of hash, and for each term the queries that ask for it with q * w."""

    terms: np.ndarray
    begins: np.ndarray
    items: np.ndarray
    gains: np.ndarray
    names: np.ndarray

    @staticmethod
    def of(rows: list) -> Block:
        """From rows (item, term, q * w)."""
        item, term, gain = (np.array([row[k] for row in rows], np.int64) for k in range(3))
        order = np.argsort(term, kind="stable")
        terms, begins = np.unique(term[order], return_index=True)
        names, numbers = np.unique(item[order], return_inverse=True)
        return Block(terms, np.append(begins, len(order)), numbers, gain[order], names)

    def asked(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, items, gains) of the active queries alone; items are numbered among these."""
        wanted = active[self.items]
        begins = np.concatenate([[0], np.cumsum(wanted)])[self.begins]
        return begins, (np.cumsum(active) - 1)[self.items[wanted]], self.gains[wanted]


def _spread(term: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry next to every query that asks for its term: numbers of entries and of (term, query) pairs."""
    counts = (begins[1:] - begins[:-1])[term]
    entry = np.repeat(np.arange(len(term)), counts)
    ahead = np.cumsum(counts) - counts
    return entry, np.arange(len(entry)) - ahead[entry] + begins[:-1][term][entry]


class Visitor:
    """Visits strata for a block of queries and keeps the best documents of each query."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.limit = np.zeros(len(block.names), np.int64)  # a query's k-th best score so far
        none = np.zeros(0, np.int64)
        self.best = (none, none, none, none, none.astype(bool))  # query, score, row, id, whether the id is null

    def visit(self, m: np.ndarray, row: np.ndarray, ids: np.ndarray, null: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Documents (m, row, id) with their postings (doc, term, tf): a few whole strata or parts of one."""
        order = np.lexsort((tf, term, m[doc]))
        doc, term, tf = doc[order], term[order], tf[order]
        of = m[doc]
        new = np.ones(len(doc), bool)
        new[1:] = (of[1:] != of[:-1]) | (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
        group = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        impact = (10**9 * tf[firsts]) // (1000 * tf[firsts] + 12 * of[firsts])  # once for all postings of a stratum, term and tf
        strata, stratum = np.unique(of[firsts], return_inverse=True)
        bounds = self._bounds(stratum, term[firsts], impact, len(strata))
        edges = np.searchsorted(of, strata, side="left"), np.searchsorted(of, strata, side="right")
        for s in np.argsort(-bounds.max(axis=0), kind="stable"):
            active = (bounds[:, s] > 0) & (bounds[:, s] >= self.limit)
            if active.any():
                part = slice(edges[0][s], edges[1][s])
                self._score(active, doc[part], term[part], impact[group[part]], row, ids, null)

    def _bounds(self, stratum: np.ndarray, term: np.ndarray, impact: np.ndarray, strata: int) -> np.ndarray:
        """(query, stratum): no document of the stratum scores more, as no term's impact is larger there."""
        last = np.ones(len(term), bool)  # groups of a term come by rising tf, so the last has the largest impact
        last[:-1] = (stratum[1:] != stratum[:-1]) | (term[1:] != term[:-1])
        entry, pair = _spread(term[last], self.block.begins)
        bounds = np.zeros((len(self.block.names), strata), np.int64)
        np.add.at(bounds, (self.block.items[pair], stratum[last][entry]), self.block.gains[pair] * impact[last][entry])
        return bounds

    def _score(self, active, doc, term, impact, row, ids, null) -> None:
        begins, items, gains = self.block.asked(active)
        names = np.flatnonzero(active)
        docs, doc = np.unique(doc, return_inverse=True)
        step = max(1, SCORES_AT_ONCE // len(names))
        order = np.argsort(doc, kind="stable")
        doc, term, impact = doc[order], term[order], impact[order]
        for low in range(0, len(docs), step):
            here = slice(*np.searchsorted(doc, [low, low + step]))
            scores = np.zeros((len(names), min(step, len(docs) - low)), np.int64)
            entry, pair = _spread(term[here], begins)
            np.add.at(scores.reshape(-1), items[pair] * scores.shape[1] + (doc[here] - low)[entry], gains[pair] * impact[here][entry])
            self._keep(names, scores, docs[low : low + step], row, ids, null)

    def _keep(self, names, scores, docs, row, ids, null) -> None:
        floor = np.maximum(self.limit[names], 1)
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k])
        query, at = np.nonzero(scores >= floor[:, None])
        found = (names[query], scores[query, at], row[docs[at]], ids[docs[at]], null[docs[at]])
        query, score, rows, own, missing = (np.concatenate(pair) for pair in zip(self.best, found))
        order = np.lexsort((rows, own, missing, -score, query))
        ordered = query[order]
        begins = np.searchsorted(ordered, ordered)
        kept = order[np.arange(len(order)) - begins < self.k]
        self.best = tuple(column[kept] for column in (query, score, rows, own, missing))
        counts = np.bincount(self.best[0], minlength=len(self.limit))
        last = np.cumsum(counts) - 1
        full = counts == self.k
        self.limit[full] = self.best[1][last[full]]

    def found(self) -> pa.RecordBatch:
        query, score, rows, own, missing = self.best
        return pa.record_batch({
            "item": pa.array(self.block.names[query], pa.int64()), "row": pa.array(rows, pa.int64()),
            "id": pa.array(own, pa.int64(), mask=missing), "score": pa.array(score, pa.int64()),
        })


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the index with a bounded number of postings (one document at least)."""
    for batch in batches:
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(int(np.searchsorted(ends, before + POSTINGS_AT_ONCE, side="right")), begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def _visited(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        visitor = Visitor(block, k)
        for part in _buffers(batches):
            terms = part.column("terms").flatten().to_numpy(zero_copy_only=False)
            tf = part.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            number = np.minimum(np.searchsorted(block.terms, terms), len(block.terms) - 1)
            asked = block.terms[number] == terms
            if asked.any():
                ids = part.column("id")
                visitor.visit(
                    part.column("m").to_numpy(), part.column("row").to_numpy(), ids.fill_null(0).to_numpy(),
                    ids.is_null().to_numpy(zero_copy_only=False), doc[asked], number[asked], tf[asked],
                )
        yield visitor.found()

    return run


def lexical_search(docs: DataFrame, queries: DataFrame, p: Ranking = Ranking(), *, key: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (doc_id, text) for every query (``key``, text)."""
    spark = docs.sparkSession
    terms = query_terms(queries, key)
    index, weights = stratified_index(docs, terms, p)
    asked = terms.join(weights, "term").select("item", "term", (F.col("q") * F.col("w")).alias("gain"))
    pairs = asked.count()
    blocks = max(1, -(-pairs // PAIRS_OF_BLOCK))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "lexical-asked")
    found = spark.createDataFrame([], FOUND)
    for number in range(blocks):
        rows = asked.filter(F.col("block") == number).select("item", "term", "gain").collect()  # of one block
        if rows:
            best = index.mapInArrow(_visited(spark.sparkContext.broadcast(Block.of(rows)), p.k), FOUND)
            found = found.unionByName(stored(best, "lexical-found") if blocks > 1 else best)
    names = terms.select("item", "item_id").distinct()
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k)
    return ranked.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
