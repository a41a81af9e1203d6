"""Connected components and exact linking of bucket members, as DataFrame steps.

Nothing here is collected: the driver sees row counts and sums only. Every round is stored, so a
lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillback.llm.frames import stored
from tillback.sources.scratch import discard

MAX_HUB_ROUNDS = 3
PAIRS_PER_MEMBER = 24  # comparing two sketches costs far less than a member's part in a round of hubs
SKETCH = [f"s{k}" for k in range(4)]


def components(links: DataFrame, label: str) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b): the smallest id that it reaches.

    Alternating large-star and small-star steps: every node hooks its larger neighbours, then its
    smaller ones, to the smallest id around it. Groups are reduced to a minimum before they are
    joined back, so a hub with millions of neighbours is never gathered in one task. Ends when a
    double step changes no link, which a count and order-free sums of the stored links tell.
    """
    edges, seen = _ordered(links), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _ordered(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        hooked = large.join(least, "b").select(F.col("a").alias("x"), F.col("b").alias("y"), "m")
        small = hooked.select(F.explode(F.array(F.struct("m", F.col("y").alias("b")), F.struct("m", F.col("x").alias("b")))).alias("e"))
        small = _ordered(small.select(F.col("e.m").alias("a"), F.col("e.b").alias("b")))
        before = edges
        edges, now = _summed(small, label)
        if seen is not None:
            discard(before)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct()
    )


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def _summed(edges: DataFrame, label: str) -> tuple[DataFrame, dict]:
    """Stored links, with sums that are equal for equal link tables."""
    watched, mixed = Observation(), F.xxhash64("a", "b")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(mixed, 24)).alias("s"), F.sum(F.shiftright(F.xxhash64(mixed), 24)).alias("t")]
    kept = stored(edges.observe(watched, *sums), f"{label}-stars")
    return kept, watched.get


def linked(
    members: DataFrame, prepare: Callable[[DataFrame], DataFrame], percent: int, label: str,
    unpack: Callable[[str], Column] | None = None,
) -> DataFrame:
    """(id, root) of ids that links within common buckets join; ids without a link are left out.

    ``members`` holds (key, id) and may hold n, the size of the id's set: ids of one key are candidates
    for each other. With a column ``least``, the smallest id of the key, it holds stored rows, of keys with several ids only.
    ``prepare`` gets the ids that share a bucket (with n) and gives their sets: (id, shingles), stored, or
    (id, packed) with ``unpack``, which makes a set from the name of a packed column, so that small
    packed values are moved instead of sets. Two ids are linked when their sets have a Jaccard
    similarity of at least ``percent`` / 100.

    Buckets are not paired with themselves. First a bucket's smallest id is compared with its other members,
    and leaves the bucket: links of a group of copies of it grow with their number, not with its square.
    Then a round compares each bucket's members with one hub (the member that most others meet). Those linked
    to it are one component. Of the others every further link needs elements outside the hub: if x and y are linked and y is not linked to the hub, they
    share more elements than y has in common with the hub. So the bucket is replaced by one bucket
    for each element outside the hub, and y needs only as many of its rarest elements there as prefix
    filtering asks for. A large group of near copies of one text falls into small buckets of texts with the
    same change. When what is left is little, its pairs from different components are compared. No
    link between components is lost. Stored steps are deleted when nothing reads them any more.

    Sizes and sketches of sets are made once for an id and go with a bucket's members; packed sets are
    unpacked only for pairs that these do not rule out.
    """
    known = [name for name in ("id", "n") if name in members.columns]
    if "least" in members.columns:
        opened = met = members
    else:
        opened = stored(_open_buckets(members.withColumn("comp", F.col("id"))), f"{label}-open")
        met = opened.join(opened.groupBy("key").agg(F.min("id").alias("least")), "key")
    kept = prepare(opened.select(*known).distinct())
    if unpack is not None:
        sets = kept = stored(_sketched(kept.select("id", "packed"), unpack("packed")), f"{label}-sets")
        sketches, pairs = sets.drop("packed"), _not_ruled_out(_stars(met), sets, percent)
    else:
        sets, unpack = kept.select("id", F.size("shingles").alias("n"), F.col("shingles").alias("packed")), F.col
        sketches, pairs = None, _stars(met)
    found = stored(confirmed(pairs, sets, percent, unpack), f"{label}-met")
    rooted = components(found, label)
    left = stored(_open_buckets(_without_least(met, rooted)), f"{label}-left")
    if sketches is None:
        asked = sets.join(left.select("id").distinct(), "id", "left_semi")
        sketches = _sketched(asked, F.col("packed")).drop("packed")
    state = stored(left.join(sketches, "id"), f"{label}-sketched")
    discard(left)
    extra, bound, used = None, 0, [kept, opened, found]
    for step in range(MAX_HUB_ROUNDS + 1):
        pairs, rows = _left_to_compare(state)
        bound = max(bound, PAIRS_PER_MEMBER * rows)
        last = step == MAX_HUB_ROUNDS or pairs <= bound
        used.append(state)
        if last:
            asked = _pairs_between(state, percent)
            asked = asked if extra is None else asked.unionByName(extra).distinct()
            found = stored(confirmed(asked, sets, percent, unpack), f"{label}-found")
            used.append(found)
        else:
            compared = stored(_with_hubs(state, sets, percent, unpack), f"{label}-hubs")
            used.append(compared)
            found = compared.filter("linked").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
            more = _smaller_partners(compared, percent)
            extra = more if extra is None else extra.unionByName(more)
        # stars say the same as the links that they were made of
        stars = rooted.filter("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))
        rooted = components(found.unionByName(stars), label)
        if last:
            discard(*used)
            return rooted
        state = stored(_finer(compared, rooted, step), f"{label}-open")


def _stars(met: DataFrame) -> DataFrame:
    """Pairs of each bucket's smallest id with the bucket's other members."""
    return met.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()


def _without_least(met: DataFrame, rooted: DataFrame) -> DataFrame:
    """(key, id, comp) of buckets whose smallest id has been compared with all others, without that id."""
    left = met.filter("id <> least").select("key", "id")
    return left.join(rooted, "id", "left").select("key", "id", F.coalesce("root", "id").alias("comp"))


def least_common(percent: int, sizes: Column) -> Column:
    """Smallest intersection of two linked sets whose sizes add up to ``sizes``."""
    return F.ceil(percent * sizes / (100 + percent)).cast("int")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, unpack: Callable[[str], Column]) -> DataFrame:
    """Pairs (a, b) whose sets have a Jaccard similarity of at least ``percent`` / 100."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("packed").alias("pa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("packed").alias("pb"))
    joined = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect(unpack("pa"), unpack("pb")))
    joined = joined.select("a", "b", common.alias("common"), (F.col("na") + F.col("nb")).alias("total"))
    return joined.filter((100 + percent) * F.col("common") >= percent * F.col("total")).select("a", "b")


def _with_hubs(state: DataFrame, sets: DataFrame, percent: int, unpack: Callable[[str], Column]) -> DataFrame:
    """Every member of a bucket next to the bucket's hub: are they linked, and what lies outside the hub?

    Any further link of the member must hit one of ``take`` elements outside the hub, whatever their
    order. ``wide`` marks members for which that holds only for partners no smaller than the hub.
    """
    counts = state.groupBy("key").agg(F.count("*").alias("members"), F.min("n").alias("least"))
    counted = state.select("key", "id").join(counts, "key")
    counted = counted.withColumn("known", F.sum("members").over(Window.partitionBy("id")))
    best = counted.groupBy("key", "least").agg(F.max(F.struct("known", (-F.col("id")).alias("less"))).alias("h"))
    hubs = best.select("key", "least", (-F.col("h.less")).alias("hub"))
    # an id has the same sketch in all its rows
    same = [F.min(name).alias(name) for name in SKETCH]
    pairs = state.join(hubs, "key").filter("id <> hub").groupBy("hub", "id").agg(F.min("least").alias("least"), *same)
    hubs = sets.select(F.col("id").alias("hub"), F.col("n").alias("m"), F.col("packed").alias("hub_packed"))
    joined = pairs.join(hubs, "hub").join(sets.select("id", "n", "packed"), "id")
    joined = joined.select(
        "hub", "id", "least", "n", "m", *SKETCH, F.array_except(unpack("packed"), unpack("hub_packed")).alias("rest"),
    ).withColumn("common", F.col("n") - F.size("rest"))
    needed = least_common(percent, F.col("n") + F.col("m")) - F.col("common")
    needed_least = least_common(percent, F.col("n") + F.col("least")) - F.col("common")
    joined = joined.withColumns({"linked": needed <= 0, "wide": (needed > 0) & (needed_least <= 0)})
    missing = F.when(F.col("linked"), 1).otherwise(F.when(F.col("wide"), needed).otherwise(needed_least))
    take = F.greatest(F.size("rest") - missing + 1, F.lit(0))
    return joined.select("hub", "id", "n", "m", *SKETCH, "linked", "wide", "rest", take.alias("take"))


def _finer(compared: DataFrame, rooted: DataFrame, step: int) -> DataFrame:
    """Members, with size and sketch, of the open buckets that take the place of each hub's members: one per rare element."""
    named = compared.select(F.col("hub").alias("key"), "id").join(rooted, "id", "left")
    left = _open_buckets(named.select("key", "id", F.coalesce("root", "id").alias("comp"))).withColumnRenamed("key", "hub")
    tokens = compared.join(left.select("hub", "id"), ["hub", "id"], "left_semi").select("hub", "id", "take", F.explode("rest").alias("token"))
    shared = F.count("*").over(Window.partitionBy("hub", "token"))
    order = F.row_number().over(Window.partitionBy("hub", "id").orderBy("shared", "token"))
    prefix = tokens.withColumn("shared", shared).withColumn("place", order).filter("place <= take and shared > 1")
    # elements are gathered, as many as a set has at most, so that sizes and sketches join once for a member
    keys = prefix.groupBy("hub", "id").agg(F.collect_list(F.xxhash64(F.lit(step), "hub", "token")).alias("keys"))
    joined = compared.select("hub", "id", "n", *SKETCH).join(left, ["hub", "id"]).join(keys, ["hub", "id"])
    finer, of_key = joined.select(F.explode("keys").alias("key"), "id", "comp", "n", *SKETCH), Window.partitionBy("key")
    # moved once, not once for the components of a bucket and again for its members
    met = finer.withColumns({"_lo": F.min("comp").over(of_key), "_hi": F.max("comp").over(of_key)}).filter("_lo < _hi")
    return met.drop("_lo", "_hi")


def _may_be_linked(one: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can have a Jaccard similarity of at least ``percent`` / 100."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _as_one() -> list[Column]:
    """Size and sketch under the names of a pair's one side."""
    return [F.col(name).alias(f"one_{name}") for name in ["n", *SKETCH]]


def _sketches_fit(percent: int) -> Column:
    """Whether sets of sizes one_n and n with these sketches can be linked.

    Sketches differ in at most as many bits as sets differ in elements, so a pair whose sketches
    differ in more than linked sets of these sizes may is surely not linked.
    """
    differing = sum(F.bit_count(F.col(name).bitwiseXOR(F.col(f"one_{name}"))) for name in SKETCH)
    alike = (100 + percent) * differing <= (100 - percent) * (F.col("n") + F.col("one_n"))
    return _may_be_linked(F.col("one_n"), F.col("n"), percent) & alike


def _not_ruled_out(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may be linked by their sizes and sketches."""
    one = sketches.select(F.col("id").alias("a"), *_as_one())
    other = sketches.select(F.col("id").alias("b"), "n", *SKETCH)
    return pairs.join(one, "a").join(other, "b").filter(_sketches_fit(percent)).select("a", "b")


def _smaller_partners(compared: DataFrame, percent: int) -> DataFrame:
    """Pairs of wide members with members of the same hub that are smaller than the hub."""
    wide = compared.filter("wide").select("hub", F.col("id").alias("one"), *_as_one())
    small = compared.filter("n < m").select(F.col("hub").alias("of"), "id", "n", *SKETCH)
    fits = (F.col("one") != F.col("id")) & _sketches_fit(percent)
    met = wide.join(small, (F.col("hub") == F.col("of")) & fits)
    return met.select(F.least("one", "id").alias("a"), F.greatest("one", "id").alias("b")).distinct()


def _left_to_compare(state: DataFrame) -> tuple[float, int]:
    """Pairs between different components of a bucket, and members, over all buckets."""
    row = state.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("own")
    ).agg(F.sum((F.col("n").cast("double") * F.col("n") - F.col("own")) / 2).alias("pairs"), F.sum("n").alias("rows")).first()
    return row["pairs"] or 0, row["rows"] or 0


def _open_buckets(state: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    keys = state.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    return state.join(keys.select("key").hint("shuffle_hash"), "key", "left_semi")


def _sketched(sets: DataFrame, elements: Column) -> DataFrame:
    """(id, n, packed) with the size n of the set and its sketch: 256 bits, each the parity of the elements that fall on it."""
    def word(k: int) -> str:
        bit = f"if(shiftright(x, 6) & 3 = {k}, shiftleft(1L, cast(x & 63 as int)), 0L)"
        return f"aggregate(elements, 0L, (bits, x) -> bits ^ {bit})"

    words = [F.expr(word(k)).alias(name) for k, name in enumerate(SKETCH)]
    return sets.select("id", "packed", elements.alias("elements")).select("id", F.size("elements").alias("n"), "packed", *words)


def _pairs_between(state: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that lie in different components, none within the largest one, and that sizes and sketches don't rule out.

    The few members outside a bucket's largest component meet all others; members of the largest
    one never meet each other.
    """
    sizes = state.groupBy("key", "comp").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("members", "comp")).alias("m")).select("key", F.col("m.comp").alias("main"))
    outside = state.join(largest, "key").filter("comp <> main").select(
        "key", F.col("id").alias("one"), F.col("comp").alias("one_comp"), "main", *_as_one(),
    )
    same = (F.col("one_comp") != F.col("comp")) & ((F.col("comp") == F.col("main")) | (F.col("one") < F.col("id")))
    same = same & _sketches_fit(percent)
    met = outside.join(state.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & same)
    return met.select(F.least("one", "id").alias("a"), F.greatest("one", "id").alias("b")).distinct()
