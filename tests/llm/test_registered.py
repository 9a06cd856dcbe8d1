"""Every registered query: against its SQL where there is one, else that it gives a row per input row."""

import pytest
from compare import connect, difference, type_difference

from candlewick.llm.queries import ORACLES, QUERIES

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = connect(SMALL)
    df = QUERIES[name](spark, SMALL)
    assert type_difference(df, con, ORACLES[name]) == []
    assert difference(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("number, table", [(n, "documents") for n in (1, 2, 3, 4, 6, 8, 9, 10, 11, 12)] + [(5, "pages")])
def test_one_row_for_each_input_row(spark, number, table):
    name = next(x for x in QUERIES if x.startswith(f"op{number}_"))
    ids = "page_id" if table == "pages" else "doc_id"
    got = sorted(r[0] for r in QUERIES[name](spark, SMALL).select(ids).collect())
    want = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(ids).collect())
    assert got == want
