"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Statistics of a text are computed once, in one pass over its words and lines; the rules of the table
become conditions on them, and nothing leaves the JVM. A rule reads "ratio of two statistics within
bounds, for texts of at least so many words".

Defined results: a null text has no words, and every count of it is 0. A word is a maximal run of
characters other than space and U+0009 to U+000D; lines end at U+000A. Rows keep their id, null or
repeated, as it is. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most frequent function words of the corpus' languages.
STOP_WORDS = """
a an and are as at be by for from has in is it its of on or that the this to was were will with
aber als auch auf aus bei das dass dem den der des die ein eine einer er es für hat ich im in ist mit nicht sich sie und von war wie wird zu
al como con de del el en es esta la las lo los más no o para pero por que se ser su sus un una y
au aux avec ce cette dans de des du elle en est et il la le les leur mais ne ou par pas plus pour qu que qui sa se ses son sur un une
""".split()
SYMBOLS = "#*$%&|<>"
GAPS = r"[ \\t\\n\\x0B\\f\\r]+"


@dataclass(frozen=True)
class Rule:
    """``part`` / ``whole`` must lie in [low, high] for texts with at least ``words`` words."""

    name: str
    part: str
    whole: str
    low: float = 0.0
    high: float = float("inf")
    words: int = 0


# Thresholds of the verdict. Ratios are of words, characters in words, or lines with a word.
RULES = (
    Rule("few_words", "n_words", "1", low=10),
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("longest_word", "longest_word", "1", high=1000),
    Rule("symbols", "n_symbols", "n_words", high=0.3),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, words=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9, words=50),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.5, words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5, words=50),
)
REPEAT_WINDOW = 5


def bound(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it under a name: lambda arguments are not expanded."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeated_words(words: str, size: int = REPEAT_WINDOW) -> str:
    """SQL for the number of words inside windows of ``size`` words that occur twice or more.

    Windows are hashed; only texts with a repeated hash sort (hash, place) pairs, find neighbours
    with equal hashes and add up how far their places reach. No step compares all pairs.
    """
    window = ", ".join(f"w[i + {k}]" if k else "w[i]" for k in range(size))
    hashes = f"transform(sequence(0, size(w) - {size}), i -> xxhash64({window}))"
    pairs = "sort_array(transform(h, (x, i) -> struct(x as x, i as i)))"
    twice = "filter(p, (e, k) -> (k > 0 and p[k - 1].x = e.x) or (k < size(p) - 1 and p[k + 1].x = e.x))"
    reach = "aggregate(q, 0L, (total, e) -> total + e)"
    steps = f"transform(s, (at, k) -> cast(if(k = size(s) - 1, {size}, least({size}, s[k + 1] - at)) as bigint))"
    places = bound(f"sort_array(transform({twice}, e -> e.i))", "s", bound(steps, "q", reach))
    counted = bound(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {bound(pairs, 'p', places)})")
    return bound(words, "w", f"if(size(w) < {size}, 0L, {counted})")


def statistics(text: str = "text") -> dict[str, str]:
    """SQL of every statistic over the columns ``words`` and ``lines``."""
    stops = ", ".join(f"'{word}'" for word in sorted(set(STOP_WORDS)))
    return {
        "n_words": "cast(size(words) as bigint)",
        "word_chars": "aggregate(words, 0L, (n, w) -> n + length(w))",
        "longest_word": "cast(coalesce(array_max(transform(words, w -> length(w))), 0) as bigint)",
        "n_symbols": f"cast(length({text}) - length(translate({text}, '{SYMBOLS}', '')) as bigint)",
        "n_stop_words": f"cast(size(filter(words, w -> lower(w) in ({stops}))) as bigint)",
        "n_lines": "cast(size(lines) as bigint)",
        "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
        "n_bullet_lines": "cast(size(filter(lines, l -> ltrim(l) rlike '^[-*\\u2022]')) as bigint)",
        "n_cut_lines": "cast(size(filter(lines, l -> rtrim(l) like '%...' or rtrim(l) like '%\\u2026')) as bigint)",
        "n_repeat_words": repeated_words("words"),
    }


def verdict(rules: tuple[Rule, ...] = RULES) -> str:
    """SQL that is true when every rule of the table holds."""
    kept = []
    for rule in rules:
        ratio = f"({rule.part}) / nullif({rule.whole}, 0)"
        bounds = [f"{ratio} >= {rule.low}"] if rule.low > 0 else []
        bounds += [f"{ratio} <= {rule.high}"] if rule.high != float("inf") else []
        kept.append(f"(n_words < {rule.words} or coalesce({' and '.join(bounds)}, true))")
    return " and ".join(kept)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, all statistics, base_failed and kept for every row of ``docs`` (doc_id, text)."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    split = texts.withColumns({
        "words": F.expr(f"filter(split(text, '{GAPS}'), w -> w <> '')"),
        "lines": F.expr("filter(split(text, '\\n'), l -> translate(l, ' \\t\\n\\u000B\\f\\r', '') <> '')"),
    })
    measured = split.select("doc_id", *[F.expr(sql).alias(name) for name, sql in statistics().items()])
    failed = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
    judged = measured.withColumn("base_failed", F.expr(failed))
    return judged.withColumn("kept", ~F.col("base_failed") & F.expr(verdict(rules)))
