import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from texts import frame, odd_rows, prose

from tillback.llm import graph
from tillback.llm.frames import stored
from tillback.llm.graph import components, linked
from tillback.llm.near_dup import NearDup, join_keys, near_duplicates, without_near_duplicates


def changed(text, share, rng):
    return " ".join(prose(rng.random(), 1) if rng.random() < share else word for word in text.split(" "))


def brute(rows, size, percent=80):
    """doc_id -> (number of shingles, smallest linked id), by comparing all documents that share a shingle."""
    sets = defaultdict(set)
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        own = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[doc] = own
    inverse = defaultdict(list)
    for doc, own in sets.items():
        for shingle in own:
            inverse[shingle].append(doc)
    common = Counter(pair for docs in inverse.values() for pair in combinations(sorted(docs), 2))
    root = {doc: doc for doc in sets}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for (a, b), n in common.items():
        if (100 + percent) * n >= percent * (len(sets[a]) + len(sets[b])):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {doc: (len(own), find(doc)) for doc, own in sets.items()}


def found(df):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in df.collect()}


def corpus():
    """Groups around one text each: some members near it, some too far from everything."""
    rng, rows = random.Random(3), []
    for group in range(6):
        base = prose(100 + group, 150)
        rows += [(len(rows), base), (len(rows) + 1, base.upper())]
        for k in range(60 if group == 0 else 12):
            rows.append((len(rows), changed(base, rng.choice([0.01, 0.02, 0.04, 0.08, 0.2]), rng)))
    rows += [(len(rows) + k, prose(1000 + k, rng.randint(1, 60))) for k in range(80)]
    rng.shuffle(rows)
    return rows


def test_groups_equal_brute_force(spark):
    rows = corpus()
    result = near_duplicates(frame(spark, rows), NearDup(words=4))
    assert found(result) == brute(rows, 4)


def test_rounds_of_hubs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("tillback.llm.graph.PAIRS_PER_MEMBER", 0.01)
    rows = corpus()
    assert found(near_duplicates(frame(spark, rows), NearDup(words=4))) == brute(rows, 4)


def test_odd_rows(spark, odd):
    result = near_duplicates(odd, NearDup(words=4)).collect()
    assert len(result) == len(odd_rows())
    by = defaultdict(list)
    for row in result:
        by[row.doc_id].append(row)
    assert all(row.component_id is None and row.kept for row in by[None])
    assert [by[k][0].n_shingles for k in (1, 2, 3, 8, 9, 10)] == [0, 0, 0, 1, 1, 1]
    assert [by[k][0].component_id for k in (1, 2, 3, 4, 5, 8, 9, 10, 11, 12)] == [1, 2, 3, 4, 4, 8, 8, 10, 11, 11]
    assert len(by[5]) == 2 and not any(row.kept for row in by[5])


def test_empty(empty):
    assert near_duplicates(empty).collect() == []


def test_keys_find_all_pairs_within_the_guaranteed_distance():
    p, rng = NearDup(), np.random.default_rng(1)
    for distance in range(p.guaranteed_distance + 1):
        for _ in range(50):
            one = rng.integers(0, 1 << p.bits, p.symbols).astype(np.uint64)
            other = one.copy()
            at = rng.choice(p.symbols, distance, replace=False)
            other[at] = (other[at] + np.uint64(1)) % np.uint64(1 << p.bits)
            keys = join_keys(np.stack([one, other]), p)
            assert (keys[0] == keys[1]).any()


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)]
    random.Random(1).shuffle(links)
    roots = {r.id: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "test").collect()}
    assert roots == {**{k: 0 for k in range(41)}, 100: 100, **{200 + k: 100 for k in range(50)}}


def test_hash_of_words_does_not_depend_on_the_slice():
    from tillback.llm.words import Words

    together = Words(pa.array(["ab cd", "", "cd ab é"]))
    alone = Words(pa.array(["cd ab é"]))
    assert together.hashes[2:].tolist() == alone.hashes.tolist() == [together.hashes[1], together.hashes[0], alone.hashes[2]]
    assert together.first.tolist() == [0, 2, 2, 5]


def test_rows_that_share_an_id_are_nodes_of_their_own(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(3, a), (7, a), (7, b), (9, b), (9, b), (None, a), (None, a), (4, None), (4, None)]
    docs = frame(spark, rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, NearDup(words=4)).collect()), key=str)
    assert got == sorted([
        (3, 57, 3, True), (7, 57, 3, False), (7, 57, 7, True), (9, 57, 7, False), (9, 57, 7, False),
        (None, 57, None, True), (None, 57, None, True), (4, 0, 4, True), (4, 0, 4, True),
    ], key=str)
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, a), (7, b), (None, a), (None, a), (4, None), (4, None)])


def test_one_of_equal_rows_stays(spark):
    a = prose(1, 60)
    docs = frame(spark, [(3, a)] * 3 + [(5, a), (3, a + " tail")])
    kept = [(r.doc_id, r.text) for r in without_near_duplicates(docs).collect()]
    assert len(kept) == 1 and kept[0][0] == 3


def test_dedup_of_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(k, prose(1, 60), "x", k) for k in range(3)], "doc_id bigint, text string, _text_hash string, t int")
    assert [tuple(r) for r in without_near_duplicates(docs).collect()] == [(0, prose(1, 60), "x", 0)]


def test_pairs_compared_grow_with_members_not_with_their_square(spark, monkeypatch):
    """Buckets of 12 alike sets, and buckets of 12 sets of one size that share little."""
    alike = {100 * g + k: (g, [1000 * g + e for e in range(40)] + [10**6 + 100 * g + k]) for g in range(20) for k in range(12)}
    rng = random.Random(5)
    apart = {10**4 + 100 * g + k: (10**3 + g, rng.sample(range(2 * 10**6, 3 * 10**6), 41)) for g in range(20) for k in range(12)}
    rows = {**alike, **apart}
    sets = spark.createDataFrame([(i, own) for i, (_, own) in rows.items()], "id bigint, shingles array<bigint>")
    members = spark.createDataFrame([(key, i) for i, (key, _) in rows.items()], "key bigint, id bigint")
    asked, confirm = [], graph.confirmed

    def counted(pairs, *others):
        asked.append(pairs.count())
        return confirm(pairs, *others)

    monkeypatch.setattr(graph, "confirmed", counted)
    got = {row.id: row.root for row in linked(members, lambda ids: stored(sets.join(ids, "id"), "test-sets"), 80, "test").collect()}
    assert got == {i: i - i % 100 for i in alike}
    assert sum(asked) <= len(rows)


def test_members_carry_sketches_and_packed_sets_are_opened_for_likely_pairs_only(spark, monkeypatch):
    """One bucket of sets that share little: sizes and sketches join once for a member, and no pair is unpacked."""
    rng = random.Random(7)
    rows = {k: rng.sample(range(10**6), 40) for k in range(60)} | {100: list(range(40)), 101: [*range(39), 77]}
    packed = stored(spark.createDataFrame([(i, own) for i, own in rows.items()], "id bigint, packed array<bigint>"), "test-packed")
    members = stored(spark.createDataFrame([(5, i, min(rows)) for i in rows], "key bigint, id bigint, least bigint"), "test-members")
    asked, confirm = [], graph.confirmed

    def counted(pairs, *others):
        asked.append(pairs.count())
        return confirm(pairs, *others)

    monkeypatch.setattr(graph, "confirmed", counted)
    got = linked(members, lambda ids: packed.join(ids, "id", "left_semi"), 80, "test", F.col).collect()
    assert {row.id: row.root for row in got} == {100: 100, 101: 100}
    assert sum(asked) == 1


@pytest.mark.parametrize("limit", [0, 24])
def test_buckets_of_rare_elements_find_the_links_that_all_pairs_have(spark, monkeypatch, limit):
    """With and without rounds of hubs, for packed sets of many sizes in one bucket."""
    rng = random.Random(3)
    rows = {}
    for k in range(90):
        base = range(1000 * (k % 6), 1000 * (k % 6) + 30)
        rows[k] = sorted({e if rng.random() > 0.09 else 50_000 + rng.randrange(40) for e in base} | set(range(90_000, 90_000 + rng.randrange(4))))
    packed = stored(spark.createDataFrame([(i, own) for i, own in rows.items()], "id bigint, packed array<bigint>"), "test-packed")
    members = stored(spark.createDataFrame([(5, i, 0) for i in rows], "key bigint, id bigint, least bigint"), "test-members")
    monkeypatch.setattr(graph, "PAIRS_PER_MEMBER", limit)
    got = {row.id: row.root for row in linked(members, lambda ids: packed.join(ids, "id", "left_semi"), 80, "test", F.col).collect()}
    own, root = {i: {*row} for i, row in rows.items()}, {i: i for i in rows}
    links = [(a, b) for a, b in combinations(rows, 2) if len(own[a] & own[b]) * 100 >= 80 * len(own[a] | own[b])]
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    several = [i for i in rows if sum(r == root[i] for r in root.values()) > 1]
    assert got == {i: root[i] for i in several} and 6 < len(several)
