import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def texts() -> list[str | None]:
    """Nulls, empty and short texts, exact and near copies, shared passages, one long text."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]

    def some(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    out = [None, "", " \n\t", "Word", "one two three", "One TWO three", "one two three"]
    out += [some(rnd.randint(20, 160)) for _ in range(60)]
    copy = some(120)
    out += [copy] * 12 + [copy.upper()]
    base = some(150).split()
    for i in range(40):  # near copies with up to five words changed
        near = list(base)
        for _ in range(i % 6):
            near[rnd.randrange(len(near))] = some(1)
        out.append(" ".join(near))
    passage = some(60)
    out += [f"{some(rnd.randint(0, 40))}\n{passage} {some(rnd.randint(0, 40))}" for _ in range(25)]
    out += [some(10) + " " + " ".join(["again"] * 80), some(20_000), f"{passage}  {passage}", "x" * 300, "é" * 120]
    return out


@pytest.fixture(scope="session")
def docs(spark):
    """The texts with nulls in the other columns, and columns named as the operators name theirs."""
    rows = [(i * 3 + 1, t, [None, "en", "fr"][i % 3], [None, "a", "b", "b", "b"][i % 5], None if i % 7 == 0 else len(t or ""))
            for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("key", "id", "node", "content", "size", "place", "part", "uid", "kept"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Null keys and rows that are repeated whole."""
    long = " ".join(f"w{i}" for i in range(90))
    return spark.createDataFrame(
        [(None, long, None, None, None), (None, None, None, None, None), (4, long, "en", "a", 1), (4, long, "en", "a", 1),
         (5, None, None, None, None), (5, "", "", "", 0), (6, "alone here", "en", "a", 10)], SCHEMA)
