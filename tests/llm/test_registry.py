"""All queries are registered, and those with SQL agree with it."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.llm.cases import ODD, by_id

NUMBERS = range(1, 14)
WITH_SQL = ["op3_url_filter", "op4_suffix_dedup", "op9_decontaminate", "op11_lexical_search", "op12_vector_search",
            "op13_merkle"]


def test_all_queries_are_registered():
    keys = E.queries()
    assert "pipeline" in keys
    for n in NUMBERS:
        assert len([k for k in keys if k.startswith(f"op{n}_")]) == 1
    assert {k for k in E.oracle_sql() if k.startswith("op")} == set(WITH_SQL)


@pytest.mark.parametrize("key", WITH_SQL)
def test_sql_agrees(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    got = E.queries()[key](spark, SF001)
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert by_id(got.select(*cols).collect()) == by_id(res.fetchall())


def test_suffix_sql_on_odd_rows():
    from loanmart.llm.suffix_dedup import OP4_SQL
    from tests.llm.test_suffix_dedup import plain_removed
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in ODD if "\x00" not in (r[1] or "")])
    rows = [r for r in ODD if "\x00" not in (r[1] or "")]
    assert by_id(con.execute(OP4_SQL).fetchall()) == by_id(plain_removed(rows, 400))
