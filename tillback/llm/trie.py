"""Prefix trie of conversations by parallel tree contraction: what sharing equal beginnings would save.

A node is a distinct sequence of first turns (role, text). Nodes are named by the exclusive or of
128-bit digests of (depth, role, text) over their turns, so that running sums name all prefixes of a
conversation, and a long conversation can be cut into blocks of turns whose sums are added up.

Subtree totals come from tree contraction. A round first *rakes*: all leaves are taken off and their
totals added to their parents. It then *compresses*: of the nodes with one child left, those whose
random number is smaller than that of such neighbours are spliced out, and what they hold is noted at
the edge of their child. Both shorten any tree to its root in a number of rounds that grows with the
logarithm of its size, whether it is wide or deep. The rounds are then read backwards: a raked node's
total was known when it was raked, a compressed one's is what it held plus the total of the child it
was spliced out above. A round is a few joins and sums by node over stored tables. Sums by parent are
partial sums, so a node with a third of all nodes as children is no hot key.

Defined results: turns are put in order by turn, null first, then role and text; a null role or text
is an empty one, and equal rows are turns of their own. Rows without a conv_id take no part. Extra
columns are ignored. An empty table has no members and gives an empty result. The digest of ids is
made by one task for a node, in order, from ready-made pieces of ids that it never holds together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillback.llm.frames import stored, visible

TURNS_OF_BLOCK = 1024
IDS_OF_PIECE = 4096
SORTED_PREFIX = 64  # characters of a text by which turns are dealt out; within a task all are compared


@dataclass(frozen=True)
class Shared:
    """Which turns of another conversation a conversation begins with: the first ``crc32(id) % turns`` of id - id % group."""

    group: int = 100
    turns: int = 6


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, i, role, text): the turns of every conversation, numbered from 1.

    Rows are dealt out by conversation and turn, so a long conversation lies in many tasks: each
    numbers its part, and the parts' sizes add up to where the next one begins.
    """
    empty = F.lit("")
    turns = visible(rows).filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"),
    )
    dealt = turns.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(SORTED_PREFIX)))
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "trie-turns")
    within = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "role", "text")
    sizes = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("begin", F.sum("size").over(earlier)).filter("begin is not null").drop("size")
    own = dealt.withColumn("i", F.row_number().over(within).cast("bigint"))
    joined = own.join(begins, ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("i") + F.coalesce("begin", F.lit(0))).alias("i"), "role", "text")


def rebuilt_conversations(turns: DataFrame, shared: Shared | None) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d, role, text) and lengths (conv_id, size) after beginnings were exchanged."""
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    if shared is None:
        return turns.withColumnRenamed("i", "d"), sizes.withColumnRenamed("n", "size")
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    heads = sizes.select("conv_id", "n", F.expr(f"conv_id - conv_id % {shared.group}").alias("base"), (crc % shared.turns).alias("h"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("available"))
    plan = heads.join(bases, "base", "left").withColumn("p", F.least("h", F.coalesce("available", F.lit(0))))
    plan = stored(plan.select("conv_id", "base", "n", "h", "p"), "trie-plan")
    own = turns.join(plan.select("conv_id", "h", "p"), "conv_id").filter("i > h")
    own = own.select("conv_id", F.expr("i - h + p").alias("d"), "role", "text")
    first = turns.filter(F.col("i") < shared.turns).withColumnRenamed("conv_id", "base")
    taken = plan.filter("p > 0").select("conv_id", "base", "p").join(first, "base").filter("i <= p")
    taken = taken.select("conv_id", F.col("i").alias("d"), "role", "text")
    return own.unionByName(taken), plan.select("conv_id", F.expr("p + greatest(n - h, 0)").alias("size"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, d, x, y, px, py, chars): the name of the prefix that each turn ends, and of the one before it."""
    whole = F.concat_ws("\n", F.col("d").cast("string"), F.length("role").cast("string"), F.col("role"), F.col("text"))
    half = "cast(conv(substr(digest, {0}, 16), 16, -10) as bigint)"
    named = turns.select("conv_id", "d", F.md5(whole.cast("binary")).alias("digest"), F.length("text").cast("bigint").alias("chars"))
    named = named.select("conv_id", "d", "chars", F.expr(half.format(1)).alias("f"), F.expr(half.format(17)).alias("g"))
    named = stored(named.withColumn("block", F.expr(f"(d - 1) div {TURNS_OF_BLOCK}")), "trie-named")
    upto = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    blocks = named.groupBy("conv_id", "block").agg(F.bit_xor("f").alias("bf"), F.bit_xor("g").alias("bg"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.withColumns({"bf": F.bit_xor("bf").over(earlier), "bg": F.bit_xor("bg").over(earlier)}).filter("block > 0")
    running = named.withColumns({"x": F.bit_xor("f").over(upto), "y": F.bit_xor("g").over(upto)})
    joined = running.join(begins, ["conv_id", "block"], "left")
    joined = joined.withColumns({"x": F.expr("x ^ coalesce(bf, 0L)"), "y": F.expr("y ^ coalesce(bg, 0L)")})
    return joined.select("conv_id", "d", "x", "y", F.expr("x ^ f").alias("px"), F.expr("y ^ g").alias("py"), "chars")


def _digests(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): a digest of the ascending ids, joined by commas, of each prefix (x, y, conv_id).

    Ids are gathered into pieces of at most ``IDS_OF_PIECE`` neighbouring numbers; a task then reads a
    node's pieces in order and feeds them to the digest one by one.
    """
    joined = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    pieces = ends.groupBy("x", "y", F.expr(f"conv_id div {IDS_OF_PIECE}").alias("piece")).agg(joined)
    ordered = pieces.repartition("x", "y").sortWithinPartitions("x", "y", "piece").select("x", "y", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            made = []
            for x, y, ids in zip(*(batch.column(name).to_pylist() for name in ("x", "y", "ids"))):
                if (x, y) != now:
                    if now is not None:
                        made.append((*now, digest.hexdigest()))
                    now, digest = (x, y), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield _named_digests(made)
        if now is not None:
            yield _named_digests([(*now, digest.hexdigest())])

    return ordered.mapInArrow(run, "x bigint, y bigint, ends_sha256 string")


def _named_digests(made: list[tuple[int, int, str]]) -> pa.RecordBatch:
    x, y, digest = zip(*made) if made else ((), (), ())
    return pa.record_batch({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64()), "ends_sha256": pa.array(digest, pa.string())})


def _watched(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    seen = Observation()
    kept = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return kept, seen.get["n"]


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(id, *sums): for every node of ``nodes`` (id, parent, *sums) the sums over its subtree, itself included.

    Roots have no parent. Any forest of finite depth will do; ids are whole numbers.
    """
    zero = F.lit(0).cast("bigint")
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("k"))
    state = nodes.join(kids, "id", "left").select(
        "id", "parent", F.coalesce("k", zero).alias("k"), *sums, *[zero.alias(f"edge_{s}") for s in sums]
    )
    state, alive = _watched(state, "trie-round")
    raked, compressed, roots = [], [], nodes.filter("parent is null").count()
    while alive > roots:
        leaves = state.filter("k = 0 and parent is not null")
        raked.append(leaves.select("id", *sums))
        state = stored(_raked(state, leaves, sums), "trie-raked")
        state, alive = _watched(_compressed(state, sums, len(raked)), "trie-round")
        compressed.append(state.filter("over is not null").select(F.col("over").alias("id"), F.col("id").alias("child"), *[f"over_{s}" for s in sums]))
    known = reduce(DataFrame.unionByName, raked, state.filter("parent is null").select("id", *sums))
    for spliced in reversed(compressed):
        child = known.select(F.col("id").alias("child"), *[F.col(s).alias(f"child_{s}") for s in sums])
        joined = spliced.join(child, "child").select("id", *[(F.col(f"over_{s}") + F.col(f"child_{s}")).alias(s) for s in sums])
        known = known.unionByName(stored(joined, "trie-expanded"))
    return known


def _raked(state: DataFrame, leaves: DataFrame, sums: list[str]) -> DataFrame:
    """The state without its leaves, whose totals are added to their parents."""
    gained = leaves.groupBy(F.col("parent").alias("id")).agg(
        F.count("*").alias("gone"), *[F.sum(F.col(s) + F.col(f"edge_{s}")).alias(f"more_{s}") for s in sums]
    )
    joined = state.filter("k > 0 or parent is null").join(gained, "id", "left")
    plus = [(F.col(s) + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in sums]
    return joined.select("id", "parent", (F.col("k") - F.coalesce("gone", F.lit(0))).alias("k"), *plus, *[f"edge_{s}" for s in sums])


def _compressed(state: DataFrame, sums: list[str], step: int) -> DataFrame:
    """The state without the spliced-out nodes; their child has one as ``over``, with what it held down to the child."""
    def luck(name: str):
        return F.xxhash64(F.lit(step), F.col(name))

    # a node with one child left, the child, and whether that has one child as well
    only = state.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count("*").alias("kids"), F.min("id").alias("child"), F.min("k").alias("child_k")
    ).filter("kids = 1").join(state.filter("k = 1 and parent is not null").select("id"), "id", "left_semi")
    only = only.select("id", "child", (F.col("child_k") == 1).alias("chain"))
    below = only.select("id", "child", "chain", F.lit(None).cast("bigint").alias("above"))
    above = only.filter("chain").select(F.col("child").alias("id"), F.lit(None).cast("bigint").alias("child"), F.lit(None).cast("boolean").alias("chain"), F.col("id").alias("above"))
    met = below.unionByName(above).groupBy("id").agg(F.max("child").alias("child"), F.max("chain").alias("chain"), F.max("above").alias("above"))
    first = F.col("above").isNull() | (luck("id") < luck("above"))
    chosen = met.filter(first & (~F.col("chain") | (luck("id") < luck("child")))).select("id", "child")
    spliced = state.join(chosen, "id").select(
        F.col("child").alias("id"), F.col("id").alias("over"), F.col("parent").alias("up"),
        *[F.col(s).alias(f"held_{s}") for s in sums], *[F.col(f"edge_{s}").alias(f"above_{s}") for s in sums],
    )
    joined = state.join(chosen.select("id"), "id", "left_anti").join(spliced, "id", "left")
    return joined.select(
        "id", F.when(F.col("over").isNotNull(), F.col("up")).otherwise(F.col("parent")).alias("parent"), "k", *sums,
        *[(F.col(f"edge_{s}") + F.coalesce(F.col(f"held_{s}") + F.col(f"above_{s}"), F.lit(0))).alias(f"edge_{s}") for s in sums],
        "over", *[(F.col(f"held_{s}") + F.col(f"edge_{s}")).alias(f"over_{s}") for s in sums],
    )


def conversation_trie(rows: DataFrame, shared: Shared | None = None) -> DataFrame:
    """One row for every node of the trie of the conversations (conv_id, turn, role, text).

    conv_id is the node's smallest member and parent_conv_id its parent's; n_convs counts members,
    n_children children, n_leaves childless nodes of the subtree; saved_tokens sums, over the subtree,
    the characters of a node's last turn for every member but one; ends_sha256 digests the ids of the
    conversations that end at the node. With ``shared``, conversations first exchange beginnings.
    """
    turns, sizes = rebuilt_conversations(numbered_turns(rows), shared)
    sizes = stored(sizes, "trie-lengths")
    found = stored(prefixes(turns), "trie-prefixes")
    nodes = found.groupBy("x", "y").agg(
        F.min("d").alias("depth"), F.min("px").alias("px"), F.min("py").alias("py"), F.min("chars").alias("chars"),
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
    )
    root = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("px"), F.lit(None).cast("bigint").alias("py"), F.lit(0).cast("bigint").alias("chars"),
        "n_convs", "conv_id",
    )
    nodes = stored(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    up = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = stored(nodes.join(up, ["px", "py"], "left").drop("px", "py"), "trie-placed")
    kids = placed.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    placed = placed.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    held = placed.select(
        "id", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(stored(held, "trie-held"), ["n_leaves", "saved_tokens"])
    ends = found.join(sizes, "conv_id").filter("d = size").select("x", "y", "conv_id")
    turnless = sizes.filter("size = 0").select(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), "conv_id")
    digests = _digests(ends.unionByName(turnless))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return placed.join(totals, "id").join(digests, ["x", "y"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
