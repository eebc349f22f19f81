import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rate string, copy string, fp string, label string, score string, length string"

LONG = "lorem ipsum dolor sit amet " * 9000
NEAR = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a bold potion of pure amber light " * 12

#: Ids that are null, repeated and out of order; texts that are null, empty, blank, long, equal and near-equal.
ROWS = [
    (7, "Alpha beta gamma delta.", "en", "a", 23),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "en", "a", 4),
    (6, "one", "en", None, 3),
    (9, "alpha BETA gamma\ndelta.", "en", "a", 23),
    (9, "alpha BETA gamma\ndelta.", "en", "a", 23),
    (11, NEAR, "en", "b", len(NEAR)),
    (12, NEAR + "end", "en", "b", len(NEAR) + 3),
    (13, NEAR, "en", "b", len(NEAR)),
    (20, LONG, "en", "b", len(LONG)),
    (None, "no id here", "en", "b", 10),
    (50, "été, ça coûte 3 € 😀 l'âme 𝔘", "fr", "b", 28),
    (100, "x" * 30000, "en", "c", 30000),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame([(*r, "r", "c", "f", "l", "s", "n") for r in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
