import random

import pytest

LONG = "wide " * 30_000


@pytest.fixture(scope="session")
def texts():
    """Texts with the cases that every operator has to stand."""
    random.seed(5)
    words = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(1, 9))) for _ in range(400)]

    def prose(count):
        return " ".join(random.choice(words) for _ in range(count))

    base = [prose(random.randint(30, 120)) for _ in range(12)]
    near = []
    for text in base[:6]:
        own = text.split()
        for _ in range(4):
            changed = list(own)
            changed[random.randrange(len(own))] = "changed"
            near.append(" ".join(changed))
    return [
        *base, *near, base[0], base[0], base[1], None, "", " \n\t ", "one", "one", "one two three", "é ß 日本語 😀  x y\r\n\n z ",
        LONG, "Same line\nSame line\n\n\nother", "idiot " + prose(40), "IDIOT, clown! " + prose(40), "| a | b |\n" * 40,
    ]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as a table with repeated rows, NULLs in every column and columns named like results."""
    rows = [
        (i, t, ["en", "fr", "de", None][i % 4], f"src{i % 3}" if i % 7 else None, len(t or ""), True, 0.5, -1)
        for i, t in enumerate(texts)
    ]
    rows += [rows[3], rows[3], (None, "no id at all but some words to read here", "en", "src0", 5, None, None, None)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, shard int"
    )
    return frame.repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.filter("false")
