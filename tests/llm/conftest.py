import random

import pytest


@pytest.fixture(scope="session")
def messy_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, ties, copies, repeated rows."""
    rng = random.Random(5)
    words = ["the", "of", "erth", "tion", "ingly", "Ön", "éau", "straße", "x", "12", "don't", "THAN,", "|"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = say(30)
    rows = [(k, say(rng.randint(1, 60)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for k in range(40)]
    rows += [(40 + k, f"{say(3)} {passage} {say(4)}", "en", "a") for k in range(6)]
    rows += [(60, rows[3][1], "en", "a"), (61, rows[3][1].replace(" ", "\n\t"), "en", "b"), (62, rows[3][1] + " ", "en", "b")]
    rows += [(70, None, "en", "a"), (71, "", None, None), (72, " \n\t", "fr", "c"), (73, "\x0b\x0c\r", "fr", "c")]
    rows += [(80, say(30_000), "en", "a"), (81, "z" * 60_000, "en", "a"), (82, "😀 " * 300, "en", "a")]
    rows += [(None, say(20), "en", "a"), (None, rows[5][1], "en", "a")]
    rows += [rows[7], rows[7], (9, rows[8][1], "en", "a")]
    return rows


NAMES = "row bits hash rank name size topic kept level tokens text_ conv label score start end part run".split()


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The rows as a table in several partitions, with more columns of all kinds of names."""
    columns = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([(*r, *["?"] * len(NAMES)) for r in messy_rows], columns).repartition(5)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")
