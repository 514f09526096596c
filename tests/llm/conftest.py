import random

import pytest

LONG = "Word " * 30_000


def sentence(rng, n, words=("the", "of", "and", "thon", "ered", "ining", "é", "tion", "on", "a")):
    return " ".join(rng.choice(words) + rng.choice(("", "", "", "s", ".")) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Null, empty, wordless, repeated, tied and very long texts."""
    rng = random.Random(3)
    same = sentence(rng, 80)
    return [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, same, "en"), (5, same, "fr"), (5, same, "fr"), (6, "x", "de"),
            (7, LONG, "en"), (8, "#$% 123", "es"), (None, same, "en"), (None, None, None), (9, sentence(rng, 200), "fr"),
            (10, 'a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" é', "en"), (11, "you are a worthless idiot. " * 3, "en")]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The rows with columns whose names the operators use inside."""
    rows = [(i, t, lang, "src", k, "clash", 0.5, [1]) for k, (i, t, lang) in enumerate(messy_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hits string, score double, items array<int>").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.filter("false")


@pytest.fixture(scope="session")
def benchmark_rows():
    return [(1, "One two three four five six seven eight nine ten eleven"), (2, "short item"), (2, "short item"), (3, None), (4, "..."), (None, "Nullen item é")]


@pytest.fixture(scope="session")
def bench_items(spark, benchmark_rows):
    return spark.createDataFrame(benchmark_rows, "item_id long, text string")


@pytest.fixture(scope="session")
def label_rows(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 12)] + [(4, None, None), (None, 1, 1), (99, 1, 0), (5, 7, 7), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
