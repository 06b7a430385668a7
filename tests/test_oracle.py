"""Every registered query against its DuckDB oracle on the smallest test folder."""

import os

import pytest

from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_queries_match_oracle(spark):
    results = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in results.items() if v[0] not in ("ok",)}
    assert not bad, bad


def test_entry_contract(spark):
    import __spark_entry__ as entry

    from almacen.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sk_cliente", "recency_dias", "frequency_trans", "monetary_val", "r_score", "f_score",
                          "m_score", "segmento_rfm", "nombre_segmento", "fec_calculo_rfm"]


def test_all_queries_on_empty_tables(spark, tmp_path_factory):
    """Every registered query runs on zero-row copies of the given tables and
    agrees with its oracle (empty or one-row results, no errors)."""
    import pyarrow.parquet as pq

    from tests.oracle_check import VIEWS

    empty = tmp_path_factory.mktemp("empty-sf")
    for name in VIEWS:
        table = pq.read_table(f"{SF}/{name}.parquet").slice(0, 0)
        pq.write_table(table, str(empty / f"{name}.parquet"))
    results = compare(spark, str(empty), verbose=False)
    bad = {k: v for k, v in results.items() if v[0] != "ok"}
    assert not bad, bad
