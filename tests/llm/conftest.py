import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, ties, nulls, empty, short and very long ones; ids repeat too."""
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(6)]
    passage = prose(rng, 60)
    texts = list(base)
    for k in range(60):
        words = base[k % 3].split()
        for _ in range(k % 9):
            words[rng.randrange(len(words))] = prose(rng, 1)
        texts.append(" ".join(words))
    texts += [base[0]] * 12 + [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(25)]
    texts += [None, "", "  \n\t", "one two", "one two", "ONE Two", "a" * 49, "a" * 50, "a" * 50, "b" * 200, "é" * 80, "é" * 80, prose(rng, 20_000)]
    rows = [(i * 3 + 1, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (4, "another text with the id of a row above", "en", "s", 1), (None, base[0], None, None, None)]
    return rows


@pytest.fixture
def docs(spark, corpus):
    # Columns that operators might use themselves.
    return spark.createDataFrame([(*r, 1.0, True, "x") for r in corpus], f"{DOCS}, score double, kept boolean, marks string").repartition(5)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)
