"""Licence scans: matching statistics of texts in a suffix automaton of licence wordings, chained to spans.

All wordings are the strings of one generalised suffix automaton over words. A text is streamed
through it: after every word the automaton's state tells the longest string of words that ends there
and stands in some wording. A match that cannot be made longer to either side is a link between a
place in the text and the places of its string in the wordings. Links that follow each other in the
text and in one wording, with few words left out on either side, form a chain; it covers a span of the
text and a share of the wording's words. A chain that covers enough of its wording gives its label.

Phrases are strings of the same automaton: one ends at a word if its state is that of the text or one
of the states behind it. They are reported wherever they stand.

A match consists of words, and of pairs of neighbours, that occur in the wordings, so only stretches of
such pairs are streamed; elsewhere the longest match is a single word or none. Stretches are found
for a whole slice of texts at once, by word hashes, and their words are then compared letter by letter.

Defined results: a null text is an empty one and has no words, no spans and the score 0. Rows are
looked at one by one, so repeated rows and ids, also null ones, give rows of their own. Extra columns
are ignored. An empty table gives an empty result. Spans are listed by first word, last word, then
label; where chains of one wording overlap, the one that covers more stays, then the earlier one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.llm.frames import by_slices, keyed_texts
from tillback.llm.license_texts import NOTICES, PHRASES
from tillback.llm.words import NO_TERM, Words

TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Scan:
    """Parameters: the shortest match in words, the longest gap within a chain, the covered share that gives a label."""

    shortest: int = 3
    gap: int = 12
    share: float = 0.6


def words_of(text: str) -> list[str]:
    """Words in lower case; only A-Z have one."""
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class SuffixAutomaton:
    """All substrings of several strings of numbers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, before: int, token: int, whole: int) -> int:
        """The state of the string ``before`` + token, parted from the longer strings it shares a state with."""
        if self.length[whole] == self.length[before] + 1:
            return whole
        part = self._state(self.length[before] + 1, dict(self.next[whole]), self.link[whole])
        self.link[whole] = part
        while before >= 0 and self.next[before].get(token) == whole:
            self.next[before][token] = part
            before = self.link[before]
        return part

    def add(self, tokens: list[int]) -> list[int]:
        """Take up a string; the states of its prefixes."""
        last, passed = 0, []
        for token in tokens:
            if token in self.next[last]:
                last = self._split(last, token, self.next[last][token])
            else:
                new, back = self._state(self.length[last] + 1, {}, 0), last
                while back >= 0 and token not in self.next[back]:
                    self.next[back][token] = new
                    back = self.link[back]
                if back >= 0:
                    self.link[new] = self._split(back, token, self.next[back][token])
                last = new
            passed.append(last)
        return passed

    def state_of(self, tokens: list[int]) -> int:
        state = 0
        for token in tokens:
            state = self.next[state][token]
        return state

    def statistics(self, tokens) -> list[tuple[int, int]]:
        """After each token: the state and length of the longest suffix that is a substring of some string."""
        state, length, found = 0, 0, []
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            found.append((state, length))
        return found


@dataclass
class Span:
    """Words ``first`` to ``last`` of a text, which cover a share of a wording's words."""

    label: str
    wording: int
    first: int
    last: int
    share: float
    phrase: bool = False


class Wordings:
    """The automaton of notices and phrases, where its strings stand, and hashes of its words and pairs."""

    def __init__(self, notices=NOTICES, phrases=PHRASES, scan: Scan = Scan()):
        self.scan = scan
        self.phrases = [(label, words_of(text)) for label, text in phrases]
        self.notices = [(label, words_of(text)) for label, text in notices]
        strings = [words for _, words in self.notices + self.phrases]
        self.words = sorted({word for words in strings for word in words})
        self.number = {word: k for k, word in enumerate(self.words)}
        numbered = [[self.number[word] for word in words] for words in strings]
        self.automaton = SuffixAutomaton()
        for tokens in numbered:  # a later string may part a state, so places are noted when all strings are in
            self.automaton.add(tokens)
        self.places = self._places(numbered[: len(self.notices)])
        self.ends = self._phrases(numbered[len(self.notices) :])
        hashes = Words(pa.array(self.words, pa.string()), gaps=NO_TERM).hashes
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        pairs = {a * len(self.words) + b for tokens in numbered for a, b in zip(tokens, tokens[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _places(self, numbered: list[list[int]]) -> dict[int, list[tuple[int, int]]]:
        """For each state of strings that may be long enough: the notices and positions where they end."""
        found, a = defaultdict(set), self.automaton
        for notice, tokens in enumerate(numbered):
            state = 0
            for end, token in enumerate(tokens):
                state = back = a.next[state][token]
                while back > 0 and a.length[back] >= self.scan.shortest:
                    found[back].add((notice, end))
                    back = a.link[back]
        return {state: sorted(places) for state, places in found.items()}

    def _phrases(self, numbered: list[list[int]]) -> dict[int, list[int]]:
        """For each state: the phrases that are suffixes of its strings."""
        own = defaultdict(list)
        for k, tokens in enumerate(numbered):
            own[self.automaton.state_of(tokens)].append(k)
        found = {}
        for state in range(len(self.automaton.next)):
            back, here = state, []
            while back > 0:
                here += own.get(back, [])
                back = self.automaton.link[back]
            if here:
                found[state] = here
        return found

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes; -1 for words that no wording has."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def links(self, tokens: list[int], begin: int):
        """Phrases and maximal matches of a stretch whose first word has the number ``begin`` in its text."""
        stats, phrases, matches = self.automaton.statistics(tokens), [], []
        for i, (state, length) in enumerate(stats):
            for k in self.ends.get(state, ()):
                label, words = self.phrases[k]
                if len(words) <= length:
                    phrases.append(Span(label, -1 - k, begin + i - len(words) + 1, begin + i, 1.0, True))
            if length >= self.scan.shortest and (i + 1 == len(stats) or stats[i + 1][1] <= length):
                matches.append((begin + i - length + 1, length, state))
        return phrases, matches

    def spans(self, stretches: list[tuple[int, list[int]]]) -> list[Span]:
        """Spans of a text from its stretches (number of the first word, word numbers)."""
        found, by_notice = [], defaultdict(list)
        for begin, tokens in stretches:
            phrases, matches = self.links(tokens, begin)
            found += phrases
            for first, length, state in matches:
                for notice, end in self.places.get(state, ()):
                    by_notice[notice].append((first, end - length + 1, length))
        for notice, links in by_notice.items():
            label, words = self.notices[notice]
            chains = chained(links, self.scan.gap, self.scan.share * len(words))
            found += [Span(label, notice, first, last, covered / len(words)) for first, last, covered in chains]
        return sorted(found, key=lambda s: (s.first, s.last, s.label, s.wording))


def chained(links: list[tuple[int, int, int]], gap: int, least: float) -> list[tuple[int, int, int]]:
    """Best chains (first word, last word, words covered) of links (text position, wording position, length).

    Only chains that cover ``least`` words count.
    A link follows another if it begins later and ends later on both sides and leaves out at most ``gap``
    words on either; where they overlap, the common words count once. Of overlapping chains the best stays.
    """
    links = sorted(set(links))
    best: list[tuple[int, int]] = []  # words covered, and the chain's first word
    window, made = 0, []
    longest = max((length for *_, length in links), default=0)
    for k, (at, there, length) in enumerate(links):
        while links[window][0] + longest + gap < at:
            window += 1
        covered, first = length, at
        for j in range(window, k):
            other_at, other_there, other = links[j]
            ahead, ahead_there = at - other_at - other, there - other_there - other
            new = length + min(ahead, ahead_there, 0)
            if max(ahead, ahead_there) <= gap and other_at < at and other_there < there and new > 0:
                if best[j][0] + new > covered:
                    covered, first = best[j][0] + new, best[j][1]
        best.append((covered, first))
        if covered >= least:
            made.append((covered, first, at + length - 1))
    return _apart(made)


def _apart(made: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Chains (first, last, covered) that do not overlap: better ones first, then earlier ones."""
    taken: dict[int, tuple[int, int, int]] = {}
    by_first = {}
    for covered, first, last in made:  # the chains of one beginning share their links
        if first not in by_first or covered > by_first[first][2]:
            by_first[first] = (first, last, covered)
    kept: list[tuple[int, int, int]] = []
    for group in _overlapping(sorted(by_first.values())):
        for chain in sorted(group, key=lambda c: (-c[2], c[0])):
            if all(chain[1] < first or last < chain[0] for first, last, _ in taken.values()):
                taken[chain[0]] = chain
        kept += sorted(taken.values())
        taken = {}
    return kept


def _overlapping(chains: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Sorted chains in groups that overlap one after the other."""
    groups, until = [], -1
    for chain in chains:
        if chain[0] > until:
            groups.append([])
        groups[-1].append(chain)
        until = max(until, chain[1])
    return groups


SPAN = pa.struct([
    ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64()), ("phrase", pa.bool_()),
])
SPANS = "doc_id bigint, n_words bigint, spans array<struct<label: string, first_word: bigint, last_word: bigint, share: double, phrase: boolean>>"


def _stretches(words: Words, wordings: Wordings):
    """(row, number of the first word within the text, word numbers) of runs of neighbours that some wording has."""
    number = wordings.numbers(words.hashes)
    if len(number) < 2:
        return
    together = (number[:-1] >= 0) & (number[1:] >= 0)
    together[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(number))] - 1] = False  # a text's last word and the next one's first
    code = number[:-1] * len(wordings.words) + number[1:]
    at = np.minimum(np.searchsorted(wordings.pairs, code), len(wordings.pairs) - 1)
    together &= wordings.pairs[at] == code
    edge = np.diff(np.concatenate([[0], together.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
    rows = np.searchsorted(words.first, begins, side="right") - 1
    for row, begin, end in zip(rows.tolist(), begins.tolist(), ends.tolist()):
        for first, tokens in _confirmed(words, wordings, number, begin, end):
            yield row, first - int(words.first[row]), tokens


def _confirmed(words: Words, wordings: Wordings, number: np.ndarray, begin: int, end: int):
    """The stretch in pieces whose words are letter by letter those that their hashes stand for."""
    tokens, first = [], begin
    for k in range(begin, end):
        token = int(number[k])
        if words.data[words.starts[k] : words.ends[k]].tobytes().lower() == wordings.words[token].encode():
            tokens.append(token)
            continue
        yield first, tokens
        tokens, first = [], k + 1
    yield first, tokens


def license_spans(docs: DataFrame, wordings: Wordings | None = None) -> DataFrame:
    """doc_id, n_words and the spans of licence wordings for every row of ``docs`` (doc_id, text)."""
    wordings = wordings or Wordings()

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"), lower=True, gaps=NO_TERM)
        by_row = defaultdict(list)
        for row, first, tokens in _stretches(words, wordings):
            by_row[row].append((first, tokens))
        made = [[] for _ in range(part.num_rows)]
        for row, stretches in by_row.items():
            made[row] = [
                {"label": s.label, "first_word": s.first, "last_word": s.last, "share": s.share, "phrase": s.phrase}
                for s in wordings.spans(stretches)
            ]
        return pa.record_batch({
            "doc_id": part.column("doc_id"), "n_words": pa.array(np.diff(words.first), pa.int64()), "spans": pa.array(made, pa.list_(SPAN)),
        })

    return keyed_texts(docs).mapInArrow(by_slices(work), SPANS)


def license_digest(spans: DataFrame) -> DataFrame:
    """Per document: phrases found (how many, first and last place, labels), labels of all spans, the best share."""
    base = spans.withColumn("base", F.filter("spans", lambda s: s["phrase"]))
    starts = F.transform("base", lambda s: s["first_word"])

    def labels(column: str):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda s: s["label"]))), ",")

    return base.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels("base").alias("base_labels"), labels("spans").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
