import pytest

LONG = "\n".join(" ".join(f"w{(i * 7 + j * j) % 977}x{i % 13}" for j in range(40)) for i in range(1500))
PASSAGE = " ".join(f"shared{i} phrase{i % 7}" for i in range(40))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with names that operators use inside."""
    rows = [
        (1, "alpha beta gamma delta\nsecond line here\nthird line of it\nfourth", "en"),
        (2, "alpha beta gamma delta\nsecond line here\nthird line of it\nfourth", "en"),
        (2, "alpha beta gamma delta\nsecond line here\nthird line of it\nfourth", "en"),
        (2, "another text under the same id " + PASSAGE, "en"),
        (3, None, None),
        (4, "", "de"),
        (5, " \n\t\x0b ", "xx"),
        (6, LONG, "en"),
        (7, LONG + "\n" + PASSAGE, "en"),
        (None, PASSAGE + " tail", "fr"),
        (None, None, None),
        (8, "head " + PASSAGE + " end", "fr"),
        (9, "x " * 400, None),
        (10, "漢字 かな 한글 текст ελληνικά עברית عربي ไทย " * 5, "zh"),
        (11, "one", "en"),
        (12, "\n\n\n", "en"),
    ]
    rows = [(i, t, lang, i, "c", None, 7, "p") for i, t, lang in rows]
    schema = "doc_id long, text string, lang string, id long, copy string, hash long, n_words int, print string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
