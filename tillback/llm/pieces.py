"""SentencePiece encoding and decoding of whole texts, with work shared between words of a common prefix.

Texts are normalised as the model asks for and cut into marked words (a run of word marks and the
characters up to the next mark); no piece of such a model goes on behind a mark. The distinct words
of a slice are sorted, which lays them out as the leaves of a trie in depth-first order, and a stack
holds the forward state of every prefix on the current path. The next word goes on from the prefix
it shares with the word before, so a common prefix is worked out once.

The state of a prefix is its last piece. For a model of merges (the given file) scores do not add
up, so the best sum of scores would not be the encoding; instead a piece may follow another if
merging the two alone gives these two pieces back, and exactly one piece ends every prefix in
that way. Characters that no
piece covers become bytes.

For a model whose scores do add up (``additive``) the state of a prefix is its forward score, the best sum of
piece scores over all its segmentations, and the piece that ends it there; of equal sums the one with the
longest last piece counts. A character without a piece costs ``UNKNOWN_COST`` more than the worst piece.

Defined results: a null or empty text has no ids. A literal word mark (U+2581) is decoded as a space.
Rows keep their id, null or repeated, as it is. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillback.llm.frames import keyed_texts, lists, slices

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
UNKNOWN_COST = 10.0
KEPT_WORDS, KEPT_PAIRS = 600_000, 1_000_000
SLICE = 4_000_000


def model_path() -> str:
    """The model of 32,000 merged pieces, whose file every executor has installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A model's pieces, and the encoding of words by forward states over prefixes."""

    def __init__(self, path: str, additive: bool = False):
        import sentencepiece

        self.additive = additive

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(k) for k in range(self.processor.vocab_size())]
        special = [self.processor.is_control(k) or self.processor.is_unknown(k) or self.processor.is_byte(k) for k in range(len(names))]
        self.numbers = {name: k for k, name in enumerate(names) if not special[k] and not self.processor.is_unused(k)}
        self.scores = {name: self.processor.get_score(k) for name, k in self.numbers.items()}
        endings: dict[str, set[int]] = {}
        for name in self.numbers:
            endings.setdefault(name[-2:], set()).add(len(name))
        # lengths of the pieces with the same last two characters, the longest first
        self.lengths = {ending: sorted(sizes - {1}, reverse=True) for ending, sizes in endings.items()}
        self.bytes = {int(BYTE.fullmatch(name)[1], 16): k for k, name in enumerate(names) if self.processor.is_byte(k)}
        self.unknown = self.processor.unk_id()
        written = [
            bytes([int(BYTE.fullmatch(name)[1], 16)]) if self.processor.is_byte(k)
            else " ⁇ ".encode() if self.processor.is_unknown(k)
            else b"" if self.processor.is_control(k) else name.replace(MARK, " ").encode()
            for k, name in enumerate(names)
        ]
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.ends = np.cumsum([len(x) for x in written])
        self.sizes = np.diff(self.ends, prepend=0)
        self.words: dict[str, np.ndarray] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.known_pairs = 0

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best pair again and again, the leftmost of equals first."""
        symbols = list(text)
        while len(symbols) > 1:
            scores = [self.scores.get(a + b, -np.inf) for a, b in zip(symbols, symbols[1:])]
            best = max(range(len(scores)), key=scores.__getitem__)
            if scores[best] == -np.inf:
                break
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def follows(self, before: str, piece: str) -> bool:
        """May ``piece`` come after ``before``: does merging both together leave them apart? Kept in ``pairs``."""
        if self.known_pairs >= KEPT_PAIRS:
            self.pairs, self.known_pairs = {}, 0
        self.known_pairs += 1
        known = self.merged(before + piece) == ([before, piece] if before else [piece])
        self.pairs.setdefault(before, {})[piece] = known
        return known

    def encode_sorted(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Pieces of sorted distinct words; states of shared prefixes are kept on a stack."""
        lengths, numbers, none, empty = self.lengths, self.numbers, (), {}
        last: list[str] = [""]  # last[j]: the piece that ends the prefix of length j
        previous = ""
        for word in words:
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in lengths.get(word[max(0, end - 2) : end], none):
                    begin = end - size
                    if begin >= 0 and word[begin:end] in numbers:
                        before, piece = last[begin], word[begin:end]
                        known = self.pairs.get(before, empty).get(piece)
                        if self.follows(before, piece) if known is None else known:
                            last.append(piece)
                            break
                else:
                    last.append(word[end - 1])
            previous, pieces, end = word, [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            yield word, pieces[::-1]

    def encode_additive(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Best segmentations of sorted distinct words by sums of scores; forward scores of shared prefixes are kept."""
        return best_segmentations(words, self.scores)

    def ids_of(self, pieces: list[str]) -> np.ndarray:
        ids: list[int] = []
        for piece in pieces:
            number = self.numbers.get(piece)
            if number is not None:
                ids.append(number)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin."""
        units, counts = [], []
        for text in texts:
            own = UNIT.findall(self.processor.normalize(text)) if text else []
            units += own
            counts.append(len(own))
        distinct = set(units)
        if len(self.words) + len(distinct) > KEPT_WORDS:
            self.words = {}
        segmented = self.encode_additive if self.additive else self.encode_sorted
        for word, pieces in segmented(sorted(distinct - self.words.keys())):
            self.words[word] = self.ids_of(pieces)
        place = {word: k for k, word in enumerate(distinct)}
        found = [self.words[word] for word in place]
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        chosen = np.fromiter(map(place.__getitem__, units), np.int64, len(units))
        ids = flat[_ragged((np.cumsum(sizes) - sizes)[chosen], sizes[chosen])]
        ends = np.concatenate([[0], np.cumsum(sizes[chosen])])
        return ids, ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the mark before the first word is dropped, broken bytes are replaced."""
        sizes = self.sizes[ids]
        text = self.written[_ragged(self.ends[ids] - sizes, sizes)].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def best_segmentations(words: list[str], scores: dict[str, float]) -> Iterator[tuple[str, list[str]]]:
    """Every one of sorted distinct words with the segmentation of the largest sum of scores.

    Viterbi over a depth-first walk of the words' trie: the forward scores of a prefix that a word
    shares with the one before are there already.
    """
    longest = max(map(len, scores), default=1)
    unknown = min(scores.values(), default=0.0) - UNKNOWN_COST
    forward: list[tuple[float, int]] = [(0.0, 0)]  # for each prefix the best sum, and where its last piece begins
    previous = ""
    for word in words:
        shared = 0
        for a, b in zip(previous, word):
            if a != b:
                break
            shared += 1
        del forward[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best = (-np.inf, end - 1)
            for begin in range(max(0, end - longest), end):
                score = scores.get(word[begin:end])
                if score is None and begin == end - 1:
                    score = unknown
                if score is not None and forward[begin][0] + score > best[0]:
                    best = (forward[begin][0] + score, begin)
            forward.append(best)
        previous, pieces, end = word, [], len(word)
        while end:
            begin = forward[end][1]
            pieces.append(word[begin:end])
            end = begin
        yield word, pieces[::-1]


def _ragged(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of all elements of runs that begin at ``begins``."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


@lru_cache(maxsize=2)
def _pieces(path: str, additive: bool = False) -> Pieces:
    return Pieces(path, additive)


def encoded(docs: DataFrame, path: str | None = None, *, additive: bool = False) -> DataFrame:
    """doc_id and ``ids`` for every row of ``docs`` (doc_id, text); ``additive`` for models whose scores add up."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, begins = _pieces(path, additive).encode(part.column("text").to_pylist())
                yield pa.record_batch({"doc_id": part.column("doc_id"), "ids": lists(ids, begins, pa.int32())})

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ``text`` for every row of ``rows`` (doc_id, ids)."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_pieces(path).decode(np.array(ids or [], np.int32)) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number and checksum of every text's ids, and a digest of the text that they decode to."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                ids, begins = _pieces(path).encode(texts)
                sums, digests, same = [], [], []
                for text, a, b in zip(texts, begins, begins[1:]):
                    back = _pieces(path).decode(ids[a:b])
                    sums.append(zlib.crc32(ids[a:b].astype("<u4").tobytes()))
                    digests.append(sha256(back.encode()).hexdigest())
                    same.append(back == text)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_ids": pa.array(np.diff(begins), pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                    "decoded_sha256": pa.array(digests, pa.string()), "same": pa.array(same, pa.bool_()),
                })

    schema = "doc_id bigint, n_ids bigint, ids_crc32 bigint, decoded_sha256 string, same boolean"
    return keyed_texts(docs).mapInArrow(run, schema)
