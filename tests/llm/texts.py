import random

SCHEMA = "doc_id bigint, text string, lang string, id string, key string, component_id int, hits int, score double, n int"
WORDS = [a + b for a in "ba de fo gi ku la me no pu ri".split() for b in "ran sel tor vim dop lus".split()]


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(doc, text, "en", "x", "y", 1, 2, 0.5, 3) for doc, text in rows], SCHEMA)


def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, ties, one endless word."""
    long = "\n".join(prose(k, 30) for k in range(400))
    return [
        (1, None), (2, ""), (3, " \t\n "), (None, prose(5, 60)), (None, None), (4, long), (5, long), (5, long), (6, "x" * 50_000),
        (7, prose(7, 80)), (7, prose(8, 80)), (8, "a b"), (9, "A B"), (10, "a b\x1cc"), (11, "\n\n" + prose(9, 90) + "\n"), (12, prose(9, 90)),
    ]
