import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "node string, sha string, size long, key string, bucket string, cluster string, row long, score double, h long")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, word-less, short, long, equal and nearly equal texts, a repeated
    row, one doc_id with two texts, repeated lines and periodic texts; extra columns with names the
    operators use themselves."""
    rng = random.Random(5)
    base, long = words(rng, 120), words(rng, 4000)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 90)
    texts = [None, "", " \t\n ", "one", "two words", base, base, base.upper(), " ".join(near), long, long + " end", "ab " * 900, "ab " * 400,
             "12345 678 !!", "é" * 30 + " ñandú über straße " + passage, passage + " tail", "line a b c\nline a b c\n\nline a b c d\n" + words(rng, 60),
             "x" * 1000, "x" * 399, "　 nbsp", "a<|endoftext|>b"]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "sé"][i % 4]) for i, t in enumerate(texts)]
    rows += [(5, base, "en", "s2"), (7, words(rng, 70), "fr", "s1"), (None, words(rng, 80), "en", "s1"), (None, None, None, None)]
    rows += [(100 + i, words(rng, 40 + i), ["en", "fr"][i % 2], "s1" if i % 3 else "s2") for i in range(40)]
    return [(d, t, lang, s, len(t) if t is not None else None, "n", "s", 1, "k", "b", "c", 2, 0.5, 3) for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge(spark):
    rows = edge_rows()
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
