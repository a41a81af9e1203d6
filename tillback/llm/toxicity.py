"""Toxicity of whole texts, scored after undoing leetspeak, spacing and repetition.

A disguised word is read as the output of a noisy channel: every character stands for itself, for a
letter it is often typed for, for a repetition of the letter before, or for mere spacing. A Viterbi
search over the letters' states finds the likeliest word under a character trigram model, whose
counts come from all texts of the corpus. The restored words are then scored by how much more often
words with the same beginning stand in texts that are labelled toxic; what is not far above the
common rate is no evidence, and a longer beginning overrules a shorter one.

Labels are read from rows outside the held-out fold, at most ``train_rows`` of them (those with the
smallest hash of their id, so the choice does not depend on the layout of the data). Near copies in
this sample count once. The character counts are a table bounded by the alphabet, and the word
evidence is bounded by the sample; only these two reach the driver.

A disguise may have any length. Signs are read within a word of letters and signs, spacing between single
characters; a letter that stands three times or more is undone in every word, and one that stands
twice in words that would begin like a telling word without it.

Defined results: a null or empty text, like any text without evidence, has the score ``floor``.
Labels that are null or not 0 or 1 are ignored; of repeated labels the larger counts. Without any
label every text has the floor. Rows keep their id; a null id is not held out and not trained on.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillback.llm.frames import by_slices, keyed_texts, slices, stored, text_bytes, visible
from tillback.llm.words import Words, constants, mixed


@dataclass(frozen=True)
class Toxicity:
    """Parameters of training and scoring."""

    train_rows: int = 20_000
    doubt: float = 4.0
    known: int = 8
    deviations: float = 5.0
    least: float = 0.5
    floor: float = 0.01
    heads: tuple[int, ...] = (6, 5, 4)


# Character classes of the language model: 0 is anything between words, 27 any other letter's byte.
CLASS = np.zeros(256, np.int32)
CLASS[np.arange(ord("a"), ord("z") + 1)] = np.arange(1, 27)
CLASS[np.arange(ord("A"), ord("Z") + 1)] = np.arange(1, 27)
CLASS[128:] = 27
CLASSES = 28

# The letters that a sign is typed for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
}
SPACING = " .-_*~"
SIGN_COST, REPEAT_COST, SPACING_COST, UNREAD_COST = 1.0, 0.5, 0.2, 12.0

# A sign between or before letters; single characters kept apart by one sign each; a letter two or three times.
DISGUISED = re.compile(
    r"(?<![^\s\"'(\[])[0-9@$!]*(?:[a-z]+[0-9@$!]+)+[a-z]+[0-9@$]*(?![a-z0-9@$])"
    r"|(?<![^\s\"'(\[])[0-9@$!]+[a-z]{2,}(?![a-z0-9@$!])"
    r"|(?<![^\s\"'(\[])(?:[a-z0-9@$!][ .\-_*~]){2,}[a-z0-9@$!](?![^\s.,;:?!\"')\]])"
)
REPEATED = re.compile(r"[a-z]*([a-z])\1\1[a-z]*")
LONG_RUN = re.compile(r"([a-z])\1{3,}")
AGAIN = re.compile(r"([a-z])\1+")
WORD = re.compile(r"[^\W\d_]{3,}")
LETTER = (CLASS > 0) & (CLASS < 27)
SIGN, GAP = np.zeros(256, bool), np.zeros(256, bool)
SIGN[[ord(c) for c in "0123456789@$!"]] = True
GAP[[ord(c) for c in SPACING]] = True


def odd_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every text: may it hold signs or spacing inside words, and does it repeat a letter twice?"""
    data, offsets = text_bytes(column)
    odd, again = np.zeros(len(data) + 1, np.int32), np.zeros(len(data) + 1, np.int32)
    if len(data) > 4:
        letter, sign = LETTER[data], SIGN[data]
        single, gap = letter | sign, GAP[data]
        # a sign just before a letter, or single characters kept apart
        odd[1:-1] += sign[:-1] & letter[1:]
        odd[1:-4] += ~single[:-4] & single[1:-3] & gap[2:-2] & single[3:-1] & ~single[4:]
        again[1:-2] += letter[:-2] & (data[:-2] | 32 == data[1:-1] | 32) & (data[1:-1] | 32 == data[2:] | 32)
    sums, repeats = np.cumsum(odd)[offsets], np.cumsum(again)[offsets]
    return np.diff(sums) > 0, np.diff(repeats) > 0


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three successive character classes over all whole texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                found = np.zeros(len(data) + 2 * len(offsets), np.int32)  # two blanks part the texts
                found[np.arange(len(data)) + 2 * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = CLASS[data]
                grams = (found[:-2] * CLASSES + found[1:-1]) * CLASSES + found[2:]
                total += np.bincount(grams, minlength=CLASSES**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    rows = keyed_texts(docs).select("text").mapInArrow(count, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES**3)
    for gram, n in rows:  # at most as many rows as there are triples of classes
        counts[gram] = n
    return counts.reshape(CLASSES, CLASSES, CLASSES)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a class after two others, shrunk towards the pair's and single counts."""
    single = (counts.sum((0, 1)) + 1) / (counts.sum() + CLASSES)
    pair = (counts.sum(0) + 20 * single) / (counts.sum((0, 2))[:, None] + 20)
    return np.log((counts + 20 * pair[None]) / (counts.sum(2)[:, :, None] + 20))


def readings(raw: str) -> list[list[tuple[str, float]]]:
    """The lattice: for every character what it may stand for ('' for nothing) and the cost."""
    lattice = []
    for k, character in enumerate(raw):
        options = []
        if character.isascii() and character.isalpha():
            options.append((character, 0.0))
            if k and raw[k - 1] == character:
                options.append(("", REPEAT_COST))
        for letter in STANDS_FOR.get(character, ""):
            options.append((letter, SIGN_COST))
        if character in STANDS_FOR and k and raw[k - 1] == character:
            options.append(("", REPEAT_COST))
        if character in SPACING:
            options.append(("", SPACING_COST))
        lattice.append(options or [("", UNREAD_COST)])
    return lattice


def restored(raw: str, model: np.ndarray) -> str:
    """Likeliest word behind ``raw``; the states are the last two letters."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # score, and the letters as (letters before, letter)
    for options in readings(raw.lower()):
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (one, two), (score, letters) in states.items():
            for letter, cost in options:
                if letter:
                    number = ord(letter) - 96
                    state, value = (two, number), (score - cost + model[one, two, number], (letters, letter))
                else:
                    state, value = (one, two), (score - cost, letters)
                if state not in following or following[state][0] < value[0]:
                    following[state] = value
        states = following
    letters, word = max(((score + model[one, two, 0], letters) for (one, two), (score, letters) in states.items()), key=lambda x: x[0])[1], []
    while letters:
        letters, letter = letters
        word.append(letter)
    return "".join(reversed(word))


class Reader:
    """Words of texts, with disguised ones restored as well."""

    def __init__(self, model: np.ndarray):
        self.restored = lru_cache(100_000)(lambda raw: restored(raw, model))

    def all(self, column: pa.Array) -> Iterator[set[str]]:
        for text, odd, again in zip(column.to_pylist(), *odd_rows(column)):
            yield self.words(text, odd, again)

    def words(self, text: str, odd: bool = True, again: bool = True) -> set[str]:
        """Words of three letters or more; ``odd`` and ``again`` spare texts that hold nothing to restore."""
        small = text.lower()
        found = set(WORD.findall(small))
        if odd:
            found.update(filter(None, [self.restored(m[0]) for m in DISGUISED.finditer(small)]))
        if again:
            found.update([self.restored(LONG_RUN.sub(r"\1\1\1", word)) for word in found if REPEATED.match(word)])
        return found


def evidence_of(word: str, p: Toxicity) -> list[str]:
    """The word itself and its beginnings, which are marked by a star, the longest first."""
    return [word, *(word[:size] + "*" for size in p.heads if len(word) >= size)]


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def evidence(docs: DataFrame, labels: DataFrame, model: np.ndarray, p: Toxicity) -> dict[str, float]:
    """Chance that a text with a word, or a word's beginning, is labelled toxic; only the telling ones."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(~held_out() & F.col("toxic").isin(0, 1))
    sample = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.train_rows)
    texts = keyed_texts(docs).join(F.broadcast(sample), "doc_id")  # bounded by train_rows

    def with_key(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"), lower=True)
        keys = np.zeros(part.num_rows, np.uint64)
        full = np.diff(words.first) > 0
        if full.any():
            begins = words.first[:-1][full]
            two = [np.minimum.reduceat(mixed(words.hashes ^ salt), begins) for salt in constants(2, 41)]
            keys[full] = mixed(two[0] ^ two[1] << np.uint64(1))
        return pa.record_batch({"key": keys.view(np.int64), "toxic": part.column("toxic"), "doc_id": part.column("doc_id"), "text": part.column("text")})

    keyed = texts.select("doc_id", "text", "toxic").mapInArrow(by_slices(with_key), "key bigint, toxic int, doc_id bigint, text string")
    single = stored(keyed.groupBy("key", "toxic").agg(F.min_by("text", "doc_id").alias("text")), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            totals = {0: Counter(), 1: Counter()}
            for words, toxic in zip(reader.all(batch.column("text")), batch.column("toxic").to_pylist()):
                totals[toxic].update({item for word in words for item in evidence_of(word, p)})
            seen = sorted(totals[0].keys() | totals[1].keys())
            yield pa.record_batch({
                "item": pa.array(seen, pa.string()), "n0": pa.array([totals[0][x] for x in seen], pa.int64()),
                "n1": pa.array([totals[1][x] for x in seen], pa.int64()),
            })

    counted = single.select("text", "toxic").mapInArrow(count, "item string, n0 bigint, n1 bigint")
    counted = stored(counted.groupBy("item").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxic-words")
    texts_of = single.groupBy("toxic").count().collect()  # two rows
    sizes = {row.toxic: row["count"] for row in texts_of}
    if not sizes.get(1):
        return {}
    rate = sizes[1] / sum(sizes.values())
    n = F.col("n0") + F.col("n1")
    chance = F.col("n1") / (n + p.doubt)
    above = (F.col("n1") - n * rate) / F.sqrt(n * rate * max(1 - rate, 1e-9))
    known = counted.filter(n >= p.known).select("item", chance.alias("chance"), "n1", above.alias("above"))
    telling = known.filter((F.col("above") >= p.deviations) & (F.col("chance") >= p.least))
    heads = {row.item[: min(p.heads)] for row in telling.collect()}  # bounded by the sample
    # what speaks against a beginning: longer beginnings and words below it
    under = known.join(F.broadcast(docs.sparkSession.createDataFrame([(head,) for head in sorted(heads)], "head string")),
                       F.substring("item", 1, min(p.heads)) == F.col("head"))
    return {row.item: row.chance for row in under.collect()}


class Scorer:
    """Score of a text: the most telling of its words."""

    def __init__(self, model: np.ndarray, weights: dict[str, float], p: Toxicity):
        self.reader, self.weights, self.p = Reader(model), weights, p
        self.head = min(p.heads)
        self.starts = {item.rstrip("*")[: self.head] for item in weights}
        self.single = {AGAIN.sub(r"\1", start) for start in self.starts}

    def all(self, column: pa.Array) -> list[float]:
        return [self.score(words | self.undoubled(words)) for words in self.reader.all(column)]

    def undoubled(self, words: set[str]) -> set[str]:
        """Restored forms of words with a doubled letter, as far as they may begin like a telling word without it."""
        found = set()
        for word in words:
            begin = AGAIN.sub(r"\1", word[: 2 * self.head])[: self.head]
            if begin in self.single and begin != word[: self.head]:
                found.add(self.reader.restored(LONG_RUN.sub(r"\1\1\1", word)))
        return found

    def score(self, words: set[str]) -> float:
        best, head, starts = self.p.floor, self.head, self.starts
        for word in words:
            if word[:head] in starts:
                chances = (self.weights.get(item) for item in evidence_of(word, self.p))
                best = max(best, next((chance for chance in chances if chance is not None), 0.0))
        return best


def trained(docs: DataFrame, labels: DataFrame, p: Toxicity) -> tuple[np.ndarray, dict[str, float]]:
    model = language_model(character_counts(docs))
    return model, evidence(docs, labels, model, p)


def scored(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity(), *, train_docs: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the column ``toxicity_score``.

    The model is fitted on ``train_docs`` where given, else on ``docs``.
    """
    model, weights = trained(docs if train_docs is None else train_docs, labels, p)
    name = "toxicity_score"
    while name in docs.columns:
        name = "_" + name
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))  # bounded by alphabet and sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value, p)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = scorer.all(part.column("text").fill_null(""))
                yield part.append_column(name, pa.array(scores, pa.float64()))

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return visible(docs).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text)."""
    rows = scored(keyed_texts(docs), labels, p)
    return rows.select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity_score").alias("score"),
        F.when(F.col("toxicity_score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity(), *, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below the limit, with the same columns."""
    rows = scored(docs, labels, p)
    return rows.filter(F.col(rows.columns[-1]) < limit).select(*[F.col(f"`{name}`") for name in docs.columns])
