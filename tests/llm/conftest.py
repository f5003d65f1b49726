import random

import pytest

#: Rows of documents as no one wants them: null ids, texts and sources, empty and blank texts, repeated rows, one id with two texts.
ODD = [
    (1, "a b c " * 30, "en", "s", 180), (1, "a b c " * 30, "en", "s", 180), (1, "another text of the same id", "en", "s", 27), (None, "no id here", None, "s", 10), (None, None, None, None, None),
    (2, None, "en", None, None), (3, "", "en", "s", 0), (4, " \n\t\n ", "de", "t", 5), (5, "x" * 3000, "en", "t", 3000), (6, "mail a.b@c.de or +1 234 567 8901\nline\nline", "en", "t", 40), (7, "é ñ ß \U0001f600 ▁ İ", "fr", "u", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    """Documents with passages and whole texts in common, and near copies."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    passage = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    out = []
    for i in range(120):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 70))) for _ in range(rng.randint(1, 6))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(passage))
        out.append("\n".join(lines))
    for i in range(30):
        own = out[i].split(" ")
        for _ in range(i % 4):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own))
    return [(i, t, "en", f"s{i % 3 if i % 2 else 0}", len(t)) for i, t in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA)
