"""What plans must not contain, planned as on a cluster where little is broadcast."""

from pathlib import Path

import pytest
from grids import KEYS, grid
from pyspark.sql import functions as F

from supplyview.operators import segments as S
from supplyview.plans import views as W
from supplyview.plans.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not present")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture
def few_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_row_python(few_broadcasts, name):
    text = plan(QUERIES[name](few_broadcasts, str(SF_DIR)))
    assert [word for word in FORBIDDEN if word in text] == []


def test_scans_read_only_what_they_need(spark):
    text = plan(W.delivery_sums(spark, str(SF_DIR)))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text
    urgent = W.read(spark, str(SF_DIR), "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(urgent.select("o_orderdate"))


@pytest.mark.parametrize(
    "name", ["status_counts", "status_counts_fixed", "category_counts", "na_products", "exclusion_counts"]
)
def test_counts_read_sums(few_broadcasts, name):
    text = plan(QUERIES[name](few_broadcasts, str(SF_DIR)))
    # The line items are summed by part before any join.
    line_scan = text.index("lineitem.parquet")
    before = text[:line_scan].splitlines()
    assert any("HashAggregate(keys=[p_partkey" in line for line in before[-12:])


def test_fuzzy_pivot_reads_the_parts_a_few_times(spark, monkeypatch):
    from supplyview import session

    read = []
    from supplyview.plans import queries

    def watched(df, name):
        read.append(plan(df).count("part.parquet"))
        return session.stage(df, name)

    monkeypatch.setattr(queries, "stage", watched)
    last = plan(QUERIES["enhanced_pivot_fuzzy"](spark, str(SF_DIR))).count("part.parquet")
    assert sum(read) + last <= 4


def test_blocks_are_joined_by_key_without_a_hint(spark):
    rows = grid(spark, {f"s{i}": [["a"]] * 4 for i in range(5)})
    logical = S.table_boundaries(rows, KEYS, block_rows=3)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical
    found = S.table_boundaries(rows, KEYS, block_rows=3).count()
    assert found == 5


def test_windows_run_inside_blocks(spark):
    rows = grid(spark, {"s": [["a"], ["a"], [None]]})
    text = plan(S.table_boundaries(rows, KEYS))
    windows = [line for line in text.splitlines() if " Window [" in line]
    inside = [line for line in windows if "_block" in line.split("], [")[1]]
    # The others run over one row per block.
    across = [line for line in windows if line not in inside]
    assert inside and all("_carry_" in line for line in across)
