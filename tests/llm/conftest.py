import pytest

from vidguard.sources.shared import ship_package

# columns that the operators add or use inside, as extra columns of their input
CLASH = ("shard", "slot", "grown_shard", "component_id", "kept", "score", "items", "rank", "size",
         "target", "taken", "copies", "number", "features", "label", "held_out", "bands", "same",
         "_text", "_row", "email", "term", "block", "first")


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and very long texts, repeated rows, ties, clashing columns."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
    rows = [(1, "one two three four five six seven", "en", "a"),
            (1, "one two three four five six seven", "en", "a"),
            (2, "ONE two\tthree\nfour five six seven", "en", "b"), (3, "", "en", "a"),
            (4, None, None, None), (None, "one two three four five six seven", "en", None),
            (None, None, None, None), (5, long, "en", "a"), (6, long + " end", "en", "b"),
            (7, "short", "en", "a"), (8, "short", "en", "b"), (9, " \t\n ", "en", "b"),
            (1, "another text under the same id as before", "en", "c")]
    return spark.createDataFrame(
        [(*r, *["x"] * len(CLASH)) for r in rows],
        "doc_id long, text string, lang string, source string, "
        + ", ".join(f"`{c}` string" for c in CLASH)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)] + [
        (None, 1, 1), (3, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
