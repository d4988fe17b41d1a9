import pytest

WORDS = "ash birch cedar elm fir hazel ivy juniper larch maple oak pine rowan spruce willow yew".split()


def text(n, start=0, step=1):
    return " ".join(WORDS[(start + i * step + i * i // 7) % len(WORDS)] + str((start + i) % 10 if i % 3 == 0 else "") for i in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    body = text(120, 3)
    rows = [
        (1, body, "en", "b"), (2, body, "en", "a"), (2, body, "en", "a"), (3, body + " tail", "en", None), (4, None, None, "a"), (5, "", "en", "a"),
        (6, "   \n\t ", "en", "c"), (None, body, "en", "a"), (None, None, None, None), (7, "One", "en", "c"), (8, "one", "en", "b"), (9, text(4000, 1), "fr", "a"),
        (10, text(30, 9, 5), "fr", "c"), (11, "é" * 50 + " " + text(40, 2, 3), None, "d"), (12, "x" * 5000, "en", "a"),
    ]
    names = "row size node held score k tie number shard slot line w place target copies".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    return spark.createDataFrame([(*r, len(r[1] or ""), *[7] * len(names)) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
