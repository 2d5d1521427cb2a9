import random

import pytest

WORDS = [a + b for a in ("th", "er", "on", "sch", "qué", "ñ", "lo") for b in ("ea", "in", "ou", "st", "é", "ble", "an")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """Documents with copies, near copies, shared passages, junk, nulls, empty and long texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(30, 160)) for _ in range(n)]
    passage = sentence(rng, 60)
    texts: list = list(base)
    texts += [base[0], base[0], base[1]]
    near = base[2].split(" ")
    near[5] = "changed"
    texts += [" ".join(near), base[3] + " tail", passage + "\n" + base[4], base[5] + " " + passage + " " + passage]
    texts += [None, "", " \n\t", "one", "two words", " x y", sentence(rng, 6000), "a" * 300, "🙂" * 40 + " end"]
    texts += ["$$$ ### " * 40, "same same same same same " * 20, "l1\nl1\n\nl2\nl1"]
    langs = ["en", "de", None]
    return [(i * 7, t, langs[i % 3], [None, "a", "b", "é", "B"][i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    # two partitions, and more columns with the names of results
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    return df.selectExpr("*", "'x' as size", "1 as n_words", "2 as kept", "3 as spans", "4 as block", "5 as copies", "6 as u", "7 as level")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
