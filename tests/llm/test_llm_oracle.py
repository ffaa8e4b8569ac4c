"""The registered statements give the queries' rows."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck_connect
from sessionlens.llm import license_scan, oracle, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_statement(spark, name):
    assert E.oracle_sql()[name] == queries.ORACLE_SQL[name]
    r = compare(E.queries()[name](spark, SF_SMALL), queries.ORACLE_SQL[name], duck_connect(SF_SMALL))
    assert r["ok"], r


def test_one_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in E.queries()) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in E.queries()


def test_license_statement_has_no_cap(spark):
    """A grant eight times on one line (528 words) has the grant's bigrams and one more."""
    import duckdb

    text = " ".join([license_scan.TEMPLATES["MIT-grant"]] * 8)
    ours = license_scan.digest(license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1::BIGINT AS doc_id, ? AS text", [text])
    rows = con.execute(oracle.LICENSE_SCAN).fetchall()
    assert [tuple(r) for r in ours] == rows and rows[0][1:3] == (1, "MIT-grant")
