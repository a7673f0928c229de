import random

import pytest

from cdcstrata.llm.batches import bound_batches

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    syllables = ["an", "the", "ing", "ti", "on", "er", "re", "ha", "st", "ou", "é", "ß"]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return bound_batches(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) pairs; sources go round."""

    def build(texts, extra=None):
        rows = []
        for k, x in enumerate(texts):
            doc_id, text = x if isinstance(x, tuple) else (k, x)
            rows.append((doc_id, text, "en", [None, "a", "b", "ü"][k % 4], len(text or "")))
        df = spark.createDataFrame(rows, SCHEMA)
        return df if extra is None else df.selectExpr("*", *extra)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tiny and long texts, repeats and near copies."""
    base = prose(1, 300)
    near = base.split(" ")
    near[150] = "changed"
    return [
        None,
        "",
        " \n\t ",
        "x",
        "one two three",
        base,
        base,
        " ".join(near),
        prose(2, 9000),
        "日本語のテキスト 😀 " * 40,
        "no" * 3000,
        "  two  spaces\n\nand lines\t\tand tabs  ",
        *[prose(k, 5 + 7 * (k % 30)) for k in range(10, 60)],
    ]
