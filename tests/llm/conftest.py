import pytest

from candlewick.llm.registry import reachable_by_workers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable_by_workers(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns under names that operators use inside."""

    def make(rows):
        full = [(i, t, "x", 1, "y", 2, "z") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, id string, mark long, words string, size int, row string")

    return make


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "an id is missing here but words are there"),
    (5, "same words again " * 40), (5, "same words again " * 40), (6, "x" * 50_000), (7, "long word list " * 20_000),
    (8, "café 漢字 😀     end\r\n"),
]
