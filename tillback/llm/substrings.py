"""Removal of repeated passages: windows of words that start at two places or more.

Candidates come from difference-cover anchors. With a cover of ``PERIOD`` positions, any two places
that share a window of ``window`` words have an offset below the period at which both positions are
in the cover, so both texts hash the same run of ``window - PERIOD + 1`` words there. Only about a
quarter of all positions are hashed and moved. Places with a repeated anchor are then extended: all
full windows around the anchor are hashed, and a window counts as repeated when its hash occurs at
another place. Equal windows always share an anchor, so none is missed.

Within a slice of texts equal anchors (and windows) are combined before the shuffle: a passage that
stands in a third of all documents sends one marked row per slice, and its other places travel
under keys of their own. Of the texts only those that may have hits are moved to be joined with them.

Defined results: a null text is an empty one and has no words. Windows are judged on the input.
Rows with the same id are told apart by their text; equal rows are two places. Rows without an id
take part. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillback.llm.frames import by_slices, keyed_texts, stored
from tillback.llm.words import U64, Words, constants, mixed

# Every difference modulo the period occurs between two of the cover's positions.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
IN_COVER = np.isin(np.arange(PERIOD), COVER)

FILTER_SLOTS = 2_097_152  # bound of the numbers that are broadcast to tell texts without hits
PLACES = "h bigint, doc_id bigint, place bigint"
TEXT_BITS = 30  # of a text's hash, which tells rows of one id apart; below it: found twice, position


def places(part: pa.RecordBatch, rows: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """One row for each hash of a slice, marked if it stands there twice; further places of a hash get keys of their own."""
    keys, twice = hashes.copy(), np.zeros(len(hashes), bool)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(begins, len(ordered)))
        firsts = order[begins]
        more = np.ones(len(hashes), bool)
        more[firsts] = False
        twice[firsts] = counts > 1
        twice[more] = True
        own = mixed(rows[more].astype(U64) << U64(40) ^ pos[more].astype(U64)) * U64(2) + constants(1, 31)
        keys[more] = mixed(hashes[more] + own)
    texts = part.column("t").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
    return pa.record_batch({
        "h": keys.view(np.int64), "doc_id": part.column("doc_id").take(pa.array(rows)),
        "place": texts << 33 | twice.astype(np.int64) << 32 | pos,
    })


def _anchors(window: int):
    length = window - PERIOD + 1

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        at, hashes = words.windows(length, seed=32)
        rows = words.rows[at]
        pos = at - words.first[rows]
        chosen = IN_COVER[pos % PERIOD]
        return places(part, rows[chosen], pos[chosen], hashes[chosen])

    return by_slices(work)


def _extended(window: int):
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        at, hashes = words.windows(window, seed=33)
        hits = part.column("hits")
        at_hits = hits.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy(zero_copy_only=False))
        place = words.first[of] + at_hits
        edges = np.zeros(len(words) + 2, np.int64)
        np.add.at(edges, np.maximum(place - PERIOD + 1, words.first[of]), 1)
        np.add.at(edges, place + 1, -1)
        near = np.cumsum(edges)[:-1] > 0
        chosen = near[at] if len(at) else np.zeros(0, bool)
        rows = words.rows[at[chosen]]
        return places(part, rows, at[chosen] - words.first[rows], hashes[chosen])

    return by_slices(work)


def _without(window: int, with_text: bool):
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        totals, removed, digests, texts = [], [], [], []
        for text, starts in zip(part.column("text").to_pylist(), part.column("hits").to_pylist()):
            words = text.encode().split()
            totals.append(len(words))
            if starts:
                edges = np.zeros(len(words) + 1, np.int64)
                begin = np.unique(np.array(starts, np.int64))
                edges[begin] += 1
                np.add.at(edges, begin + window, -1)
                keep = np.cumsum(edges)[:-1] == 0
                words = [word for word, kept in zip(words, keep) if kept]
            kept_text = b" ".join(words)
            removed.append(totals[-1] - len(words))
            digests.append(hashlib.sha256(kept_text).hexdigest())
            if with_text:
                texts.append(kept_text.decode())
        columns = {
            "doc_id": part.column("doc_id"), "n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        return pa.record_batch(columns | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    return by_slices(work)


def _repeated(found: DataFrame) -> DataFrame:
    """Positions per row of the table whose key occurs at another place as well."""
    places_of = F.count("*").over(Window.partitionBy("h"))
    twice = found.withColumn("places", places_of).filter("places > 1 or (place & 4294967296) <> 0")
    named = twice.select("doc_id", F.shiftright("place", 33).cast("int").alias("t"), F.expr("cast(place & 4294967295 as int)").alias("pos"))
    return named.groupBy("doc_id", "t").agg(F.collect_list("pos").alias("hits"))


def _slot():
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_SLOTS)).cast("int").alias("slot")


def _parted(texts: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that may have hits, and texts that surely have none; the latter need not move to be joined.

    Told by slots that ids with hits fall into, of which there is a fixed number at most.
    """
    taken = F.broadcast(hits.select(_slot()).distinct())
    slotted = texts.select("*", _slot())
    return tuple(slotted.join(taken, "slot", how).drop("slot") for how in ("left_semi", "left_anti"))


def _beside(texts: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    right = hits.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "hits").hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))
    return texts.join(right, same, how).select("doc_id", "t", "text", "hits")


def _told_apart(texts: DataFrame) -> DataFrame:
    """Texts with the column ``t``, which tells rows of one id apart.

    It is a hash of the text, and 0 where ids are unique: it travels with every place, and a value
    that never changes takes no room in a compressed shuffle.
    """
    known = texts.select("doc_id").filter("doc_id is not null")
    unique = known.groupBy("doc_id").count().filter("count > 1").isEmpty()
    own = F.hash("text").bitwiseAND((1 << TEXT_BITS) - 1)
    return texts.withColumn("t", F.when(F.col("doc_id").isNotNull(), 0).otherwise(own) if unique else own)


def without_repeats(docs: DataFrame, window: int = 35, *, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text for every row of ``docs`` (doc_id, text)."""
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    texts = _told_apart(keyed_texts(docs))
    hits = stored(_repeated(texts.mapInArrow(_anchors(window), PLACES)), "passage-anchors")
    near, _ = _parted(texts, hits)
    starts = stored(_repeated(_beside(near, hits, "inner").mapInArrow(_extended(window), PLACES)), "passage-starts")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
    touched, whole = _parted(texts, starts)
    rows = _beside(touched, starts, "left").unionByName(whole.select("doc_id", "t", "text", F.lit(None).cast("array<int>").alias("hits")))
    return rows.mapInArrow(_without(window, with_text), schema)
