"""Licence scans against plain searches."""

import random

import pytest
from texts import frame, prose

from tillback.llm.license_texts import NOTICES, PHRASES
from tillback.llm.licenses import Scan, SuffixAutomaton, Wordings, chained, license_digest, license_spans, words_of


def longest_suffixes(tokens, strings):
    """Length of the longest string of tokens that ends at each place and stands in some string."""
    known = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    return [max((n for n in range(1, k + 2) if tuple(tokens[k + 1 - n : k + 1]) in known), default=0) for k in range(len(tokens))]


@pytest.mark.parametrize("seed", range(30))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    strings = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 6))]
    automaton = SuffixAutomaton()
    for string in strings:
        automaton.add(string)
    tokens = [rng.randrange(4) for _ in range(60)]
    stats = automaton.statistics(tokens)
    assert [length for _, length in stats] == longest_suffixes(tokens, strings)
    for k, (state, length) in enumerate(stats):
        if length:
            assert automaton.state_of(tokens[k + 1 - length : k + 1]) == state


def plain_phrases(text):
    words = words_of(text or "")
    places = []
    for label, phrase in PHRASES:
        own = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    starts = [k for k, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places})),
    )


def texts_with_licences():
    rng = random.Random(4)
    made = [None, "", " \n", "MIT License", "the mit\n license.apache-license", "mit", "licensemit license", "MİT LICENSE", "x" * 50_000]
    for _ in range(200):
        parts = [rng.choice([prose(rng.random(), 3), *(p for _, p in PHRASES), "MIT", "License", "GENERAL public", "the", "of the", "é"]) for _ in range(12)]
        made.append(rng.choice([" ", "\n", "-", "_"]).join(parts))
    made.append("mit license " * 30_000)
    return made


def test_phrases_are_found_wherever_they_stand(spark):
    texts = texts_with_licences()
    rows = license_digest(license_spans(frame(spark, list(enumerate(texts))))).collect()
    for row in rows:
        assert tuple(row)[1:6] == plain_phrases(texts[row["doc_id"]])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
    assert len(rows) == len(texts)


@pytest.mark.parametrize("number", range(len(NOTICES)))
def test_every_notice_is_found_in_full(number):
    label, text = NOTICES[number]
    wordings = Wordings()
    before = [word for word in prose(1, 5).split()]
    words = [*before, *words_of(text), *before]
    spans = [s for s in spans_of(wordings, words) if s.label == label and not s.phrase]
    assert any((s.first, s.last, s.share) == (5, 4 + len(words_of(text)), 1.0) for s in spans)


def spans_of(wordings, words):
    runs, begin = [], 0
    numbers = [wordings.number.get(word, -1) for word in words]
    for k in range(len(numbers) + 1):
        if k == len(numbers) or numbers[k] < 0:
            if k > begin:
                runs.append((begin, numbers[begin:k]))
            begin = k + 1
    return wordings.spans(runs)


def test_changed_words_are_chained_over():
    label, text = next((label, text) for label, text in NOTICES if label == "bsd")
    words = words_of(text)
    changed = words[:10] + ["something", "else"] + words[11:30] + words[33:]
    best = max((s for s in spans_of(Wordings(), changed) if s.label == "bsd"), key=lambda s: s.share)
    assert (best.first, best.last) == (0, len(changed) - 1)
    assert best.share == pytest.approx((len(words) - 4) / len(words))


def test_half_a_notice_gives_no_label():
    words = words_of(next(text for label, text in NOTICES if label == "mpl"))
    assert not spans_of(Wordings(), words[: len(words) // 2])


def test_links_far_apart_are_no_chain():
    assert chained([(0, 0, 4), (40, 4, 4)], 12, 1) == [(0, 3, 4), (40, 43, 4)]
    assert chained([(0, 0, 4), (10, 4, 4)], 12, 1) == [(0, 13, 8)]
    assert chained([(0, 4, 4), (10, 0, 4)], 12, 1) == [(0, 3, 4), (10, 13, 4)]
    assert chained([(0, 0, 4), (2, 2, 4)], 12, 1) == [(0, 5, 6)]


def test_every_copy_in_a_text_is_a_span(spark):
    text = "\n".join([prose(1, 4), "All Rights Reserved.", prose(2, 9)] * 500)
    (row,) = license_spans(frame(spark, [(1, text)])).collect()
    assert [(s["first_word"], s["label"]) for s in row["spans"]] == [(16 * k + 4, "reserved") for k in range(500)]


def test_own_wordings(spark):
    wordings = Wordings([("house", "for use within the house only")], [("ours", "our licence")], Scan(shortest=2))
    rows = license_spans(frame(spark, [(1, "OUR licence: for use within the house"), (2, "within our house")]), wordings).collect()
    assert [[(s["label"], s["first_word"], s["last_word"]) for s in row["spans"]] for row in rows] == [[("ours", 0, 1), ("house", 2, 6)], []]


def test_odd_rows(odd, empty):
    rows = license_digest(license_spans(odd)).collect()
    assert len(rows) == odd.count() and all(row["n_base"] == 0 and row["labels"] == "" and row["score"] == 0 for row in rows)
    assert license_digest(license_spans(empty)).collect() == []
