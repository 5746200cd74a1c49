import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, uid string, row string, key double, ids string, n_tokens string, score string, n string, fp string"


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows; columns with the operators' own names."""
    rng = random.Random(5)
    words = "the of and Über, naïve it's don't 12.5 foo-bar!! ### | éa ça".split()
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) * rng.randrange(2) for _ in range(n))
    shared = prose(60)
    texts = [None, "", "   ", "\t\n", "one", "two words", " two  words ", "two\twords"]
    texts += [prose(n) for n in (3, 4, 5, 34, 35, 36, 80)]
    texts += [prose(20) + " " + shared, shared + "\n" + prose(30), shared, "a b " * 100]
    texts += [prose(20_000), "x" * 70_000 + " end", "<|startoftext|> é W̊ <|endoftext|>x y\x1cz"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(7, "two\twords"), (7, "two\twords"), (None, "one"), (None, None), (500, shared), (400, shared)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t), "u", "r", 0.5, "i", "t", "s", "n", "f") for i, t in odd_rows()]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
