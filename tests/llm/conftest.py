import random

import pytest


def words_text(rng, pool, low, high):
    return " ".join(rng.choices(pool, k=rng.randint(low, high)))


@pytest.fixture(scope="session")
def odd_rows():
    """doc_id, text: nulls, empty and blank texts, repeated rows, ties in doc_id, near and exact copies, a very long text."""
    rng = random.Random(4)
    pool = [f"wort{i}" for i in range(300)] + ["É", "été", "l'eau", "x9", "\n", "it's", "漢字", "\x1c", "<|endoftext|>"]
    rows = []
    for _ in range(25):
        base = rng.choices(pool, k=rng.randint(2, 120))
        for _ in range(rng.randint(1, 6)):
            some = list(base)
            for _ in range(rng.randint(0, 2)):
                some[rng.randrange(len(some))] = rng.choice(pool)
            rows.append((len(rows), " ".join(some)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "ONE"), (1005, "123 456"), (None, rows[0][1]), (None, None)]
    rows += [rows[3], rows[3], (rows[4][0], rows[9][1]), (1006, words_text(rng, pool, 60_000, 60_000)), (1007, "a" * 5000), (1008, "a" * 5000)]
    return rows


@pytest.fixture()
def odd_docs(spark, odd_rows):
    """The odd rows with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in odd_rows], "doc_id long, text string, lang_pred string, n_words int, node string").repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
