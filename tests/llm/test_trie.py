"""The conversation trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tillback.llm import trie
from tillback.llm.trie import Shared, conversation_trie, subtree_totals

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id bigint, parent string, x int, d int, k int"


def plain_trie(rows, shared):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(found)] for conv, found in turns.items()}
    built = turns
    if shared:
        built = {}
        for conv, own in turns.items():
            h = zlib.crc32(str(conv).encode()) % shared.turns
            built[conv] = turns.get(conv - conv % shared.group, [])[:h] + own[h:]
    members = defaultdict(list)
    for conv, own in built.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(conv)
    result = []
    for path, convs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        parents = [p for p in members if p]
        result.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(p[:-1] == path for p in parents), sum(not any(q[:-1] == p for q in parents) for p in under),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


def found_trie(spark, rows, shared):
    df = spark.createDataFrame([(*row, 1, "p", 2, 3, 4) for row in rows], SCHEMA)
    return sorted((tuple(row) for row in conversation_trie(df, shared).collect()), key=repr)


def some_rows(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv * 7 % 500, rng.choice([turn, turn, turn, None, 0]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "é\n", "", None])))
    return rows + [(None, 1, "user", "lost"), (3, 9, "user", "z" * 100_000)] + rows[:20]


@pytest.mark.parametrize("shared", [None, Shared()])
def test_against_a_plain_trie(spark, shared):
    rows = some_rows(5)
    assert found_trie(spark, rows, shared) == plain_trie(rows, shared)


def test_long_conversations_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "TURNS_OF_BLOCK", 4)
    monkeypatch.setattr(trie, "IDS_OF_PIECE", 8)
    rows = [(conv, turn, "user", "same") for conv in range(0, 60) for turn in range(11 + conv % 3)]
    assert found_trie(spark, rows, Shared(turns=4)) == plain_trie(rows, Shared(turns=4))


def test_only_empty_beginnings(spark):
    # crc32 decides that 1 and 3 begin with turns of conversation 0, which does not exist
    rows = [(conv, 0, "user", "hello") for conv in (1, 2, 3, 101)]
    assert found_trie(spark, rows, Shared()) == plain_trie(rows, Shared())


def test_empty_table(spark):
    assert found_trie(spark, [], Shared()) == []


def plain_totals(nodes):
    totals = {i: v for i, _, v in nodes}
    kids = defaultdict(list)
    for i, parent, _ in nodes:
        kids[parent].append(i)
    order, ahead = [], list(kids[None])
    while ahead:
        i = ahead.pop()
        order.append(i)
        ahead += kids[i]
    parents = {i: parent for i, parent, _ in nodes}
    for i in reversed(order):
        if parents[i] is not None:
            totals[parents[i]] += totals[i]
    return totals


def random_tree(seed, size):
    rng = random.Random(seed)
    return [(i, None if i == 0 else rng.randrange(max(0, i - 5), i), rng.randrange(-9, 99)) for i in range(size)]


TREES = {
    "path": [(i, i - 1 if i else None, i) for i in range(60)],
    "star": [(i, 0 if i else None, 1) for i in range(500)],
    "random": random_tree(1, 300),
    "forest": [(1, None, 5), (2, None, 6), (3, 2, 7)],
    "one": [(8, None, 3)],
}


@pytest.mark.parametrize("name", list(TREES))
def test_subtree_totals(spark, name):
    nodes = spark.createDataFrame(TREES[name], "id bigint, parent bigint, v bigint")
    assert {row["id"]: row["v"] for row in subtree_totals(nodes, ["v"]).collect()} == plain_totals(TREES[name])
