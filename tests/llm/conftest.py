import re

import pytest

#: Words as the operators' contracts define them.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


#: Null, empty, blank, short, repeated and long texts, with ids that repeat and one that is missing.
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two"), (5, "The quick brown fox. " * 30), (6, "The quick  brown\nfox. " * 30), (7, "a b c d e f g h i j k l"), (7, "a b c d e f g h i j k l"),
    (8, "naïve ÉCOLE 世界 🙂 " * 20), (9, "x" * 50_000 + " " + "y z " * 20_000), (10, "the MIT License. Apache-License; GENERAL PUBLIC LICENSE"), (11, "### $$$ *** |||\nhome | about | login | help"), (None, "no id here"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", None if (i or 0) % 4 == 0 else f"s{(i or 0) % 3}", len(t or ""), -1, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, name string").repartition(3).cache()
