import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A table of documents; ``extra`` adds columns whose names the operators use themselves."""

    def make(rows, extra=True):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        if extra:
            for name in ("id", "h", "n", "part", "rep", "key"):
                frame = frame.selectExpr("*", f"'clash' AS `{name}`")
        return frame

    return make


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies."""
    rng = random.Random(5)

    def words(n):
        return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 6))) for _ in range(n)]

    rows = [(None, "a text without an id"), (1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "two words")]
    base = words(120)
    rows += [(10, " ".join(base)), (11, " ".join(base)), (11, " ".join(base)), (12, " ".join(base).upper())]
    for n in range(40):  # near copies of one text
        changed = list(base)
        for _ in range(rng.randint(1, 4)):
            changed[rng.randrange(len(changed))] = "".join(rng.choice(LETTERS) for _ in range(5))
        rows.append((20 + n, " ".join(changed)))
    for n in range(30):
        own = words(rng.randint(4, 60))
        rows.append((100 + n, " ".join(own)))
        if n % 3 == 0:
            rows.append((200 + n, " ".join(own[:-1] + ["x"])))
    passage = " ".join(words(100))
    rows += [(300 + n, " ".join(words(30)) + " " + passage + "\n" + " ".join(words(n))) for n in range(5)]
    rows += [(400, " ".join(words(30_000))), (401, "ab" * 3000), (402, "é" * 700), (403, "x")]
    return rows
