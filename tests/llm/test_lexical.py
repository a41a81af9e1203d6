"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from texts import frame, odd_rows

from tillback.llm import lexical
from tillback.llm.lexical import Block, Ranking, Visitor, lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counted = [(doc, Counter(terms_of(text))) for doc, text in docs]
    counted = [(doc, terms) for doc, terms in counted if terms]
    documents, length = len(counted), sum(sum(terms.values()) for _, terms in counted)
    df = Counter(term for _, terms in counted for term in terms)
    result = []
    for item, text in items:
        if item is None:
            continue
        scores = []
        for doc, terms in counted:
            m = 75 + 25 * sum(terms.values()) * documents // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * terms[t] // (1000 * terms[t] + 12 * m))
                for t in terms_of(text) if t in terms
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        result += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(result, key=repr)


def found_search(spark, docs, items, k):
    queries = spark.createDataFrame([(item, text, 1, 2, "x") for item, text in items], "item_id bigint, text string, id int, row int, term string")
    return sorted((tuple(row) for row in lexical_search(frame(spark, docs), queries, Ranking(k=k)).collect()), key=repr)


def some_docs(seed, count=300):
    rng = random.Random(seed)
    words = ["the"] * 30 + ["Of"] * 15 + ["été", "x1", "42"] * 4 + [f"w{k}" for k in range(60)]
    return [(rng.randrange(10_000), rng.choice([" ", "-", "_", "\n"]).join(rng.choice(words) for _ in range(rng.choice([1, 5, 20, 60])))) for _ in range(count)]


ITEMS = [
    (1, "the of"), (2, "The w1 w2 w2 w3 of THE"), (3, "nothing here"), (4, ""), (5, None), (None, "the w1"), (6, "w7"),
    (7, " ".join(f"w{k}" for k in range(60))), (8, "été X1 42"), (7, "w1 the"),
]


@pytest.mark.parametrize("k", [1, 20, 1000])
def test_against_scores_of_all(spark, k):
    docs = some_docs(1)
    assert found_search(spark, docs, ITEMS, k) == plain_search(docs, ITEMS, k)


def test_small_steps(spark, monkeypatch):
    """Several blocks of queries, few postings and few scores at a time."""
    monkeypatch.setattr(lexical, "PAIRS_OF_BLOCK", 20)
    docs = some_docs(2, 120)
    assert found_search(spark, docs, ITEMS, 12) == plain_search(docs, ITEMS, 12)


@pytest.mark.parametrize("k, at_once", [(1, 1), (3, 7), (3, 100)])
def test_strata_are_skipped_only_where_no_score_can_count(monkeypatch, k, at_once):
    monkeypatch.setattr(lexical, "SCORES_AT_ONCE", at_once)
    rng = np.random.default_rng(k)
    block = Block.of([(item, term, int(rng.integers(1, 50))) for item in range(6) for term in rng.choice(9, 4, replace=False)])
    visitor, every = Visitor(block, k), {}
    for part in range(5):
        m, row = rng.integers(75, 80, 20), np.arange(20) + 100 * part
        doc = np.repeat(np.arange(20), 3)
        term = np.concatenate([rng.choice(len(block.terms), 3, replace=False) for _ in range(20)])
        tf = rng.integers(1, 4, 60)
        for item in range(len(block.names)):
            own = dict((t, g) for t in range(len(block.terms)) for i, g in zip(block.items[block.begins[t] : block.begins[t + 1]], block.gains[block.begins[t] : block.begins[t + 1]]) if i == item)
            for d in range(20):
                score = sum(int(own.get(t, 0)) * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[d]))) for e, t, f in zip(doc, term, tf) if e == d)
                if score:
                    every.setdefault(int(block.names[item]), []).append((-score, int(row[d])))
        visitor.visit(m, row, row, np.zeros(20, bool), doc, term, tf)
    found = visitor.found().to_pylist()
    assert sorted((r["item"], -r["score"], r["row"]) for r in found) == sorted((item, *best) for item, own in every.items() for best in sorted(own)[:k])


def test_odd_rows_and_ties(spark):
    docs = odd_rows() + [(k, "alpha beta") for k in range(40, 10, -1)] + [(15, "alpha beta"), (None, "alpha beta")]
    items = [(1, "alpha"), (2, "beta alpha alpha"), (3, "a b c")]
    assert found_search(spark, docs, items, 25) == plain_search(docs, items, 25)


def test_empty_tables(spark):
    assert found_search(spark, [], ITEMS, 5) == []
    assert found_search(spark, some_docs(3, 5), [], 5) == []
    assert found_search(spark, [(1, None), (2, " ")], ITEMS, 5) == []
