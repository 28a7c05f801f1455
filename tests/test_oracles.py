"""Every query of the catalog against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

from tidelark.catalog import ORACLES, QUERIES, flagship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, SF))
    assert len(columns) == len(set(columns))
    if name in ORACLES:
        assert (columns, rows) == oracle.duck_rows(duck, ORACLES[name])


def test_flagship_has_rows(spark):
    assert flagship(spark, SF).count() > 0


def test_patch_takes_the_whole_table(spark, duck):
    rows = {r["k"]: r["v"] for r in QUERIES["g02_patch_table"](spark, SF).collect()}
    keys = {k for (k,) in duck.execute("SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0").fetchall()}
    suppliers = duck.execute("SELECT count(*) FROM supplier").fetchone()[0]
    assert keys <= set(rows) and 0 < sum(k not in keys for k in rows) < suppliers


def test_every_customer_can_reject_a_pair(spark, duck):
    kept = {r["s_suppkey"] for r in QUERIES["j14_rejected_pairs_table"](spark, "/root/testdata/sf0.1").collect()}
    big = oracle.connection("/root/testdata/sf0.1")
    n = big.execute("SELECT count(*) FROM supplier").fetchone()[0]
    late = {k for (k,) in big.execute(f"SELECT s_suppkey FROM supplier JOIN customer ON s_nationkey = c_nationkey AND s_suppkey % {n} = c_custkey % {n} WHERE c_mktsegment = 'MACHINERY' AND c_custkey >= 200").fetchall()}
    assert late and kept and not kept & late


def test_normalised_join_compares_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, " alpha  beta"), (2, "alpha gamma"), (3, "al")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, "alpha beta"), (8, "alphabet")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(map(tuple, QUERIES["j28_normalised_join_whole"](spark, str(tmp_path)).collect()))
    assert got == [(-9, 8), (-8, 7), (1, 7)]
