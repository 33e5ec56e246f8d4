import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def make_rows(seed: int = 3, n: int = 120) -> list[tuple]:
    """Small documents with copies, near copies, blanks, repeated ids, junk and a long text."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "and", "to", "Der", "É", "漢字"]
    rows = []
    for i in range(n):
        if i % 5 == 1 and rows and rows[-1][1]:
            text = rows[-1][1]
        elif i % 5 == 2 and rows and rows[-1][1]:
            held = rows[-1][1].split(" ")
            held[draw.randrange(len(held))] = "changed"
            text = " ".join(held)
        else:
            text = " ".join(draw.choices(words, k=draw.choice([0, 1, 3, 4, 30, 80, 200])))
        if i % 17 == 4:
            text = text.replace(" ", "\n\t ").upper()
        rows.append((i, text, ["en", "de", None, "fr"][i % 4], f"s{i % 3}", len(text)))
    rows += [
        (1000, None, "en", None, None), (1001, "", None, "s1", 0), (1002, " \n\t\x0b\x0c\r ", "en", "s2", 7),
        (1003, "word " * 6000, "en", "s0", 30000), (None, "a text without number", "en", "s1", 21),
        (None, "a text without number", "en", "s1", 21), (7, "another text of document seven", None, "s2", 30),
        (1004, "x", "en", "s1", 1), (1004, "x", "en", "s1", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
