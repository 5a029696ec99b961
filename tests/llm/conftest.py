"""Documents that hold every awkward case, small."""

import pytest

LONG = " ".join(f"w{i % 977} x{i * i % 991}," for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

TEXTS = [
    (0, "The the erntre this to be is he. Nt it anoust.\nAnd theaea sh, therth."),
    (1, None),
    (2, ""),
    (3, " \t\n \x0b\x0c\r "),
    (4, "one"),
    (5, "ONE"),
    (6, "Éàü ß  日本語 テキスト 👍🏽 it's  we'll\t'd\n\n x \x1c y \x85 z q"),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "a b c d e f g h i j k l m n o p q r s t"),
    (10, "zz a b c d e f g h i j k l m n o yy"),
    (11, "a b c d e f g h i j k l m n o p q r s t"),
    (11, "a b c d e f g h i j k l m n o p q r s t"),
    (12, f"before {PASSAGE} after"),
    (13, f"other\t{PASSAGE}\nend"),
    (None, f"nobody's {PASSAGE}"),
    (None, None),
    (14, "1234 5678 !!! ---"),
    (15, "x" * 5000),
    (16, "<|endoftext|> and <|endoftext|>"),
    (17, "line\nline\nline\nother line of words\nother line of words\n"),
]


@pytest.fixture(scope="session")
def rows():
    return [(i, t, "en" if (i or 0) % 2 else None) for i, t in TEXTS]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns whose names the operators use inside."""
    clash = "row int, slice int, leaf string, rank int, length int, file int, cell int, `a.b` int"
    data = [(*row, k, 1, "leaf", 2, 3, 4, 5, 6) for k, row in enumerate(rows)]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, {clash}").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < 0")
