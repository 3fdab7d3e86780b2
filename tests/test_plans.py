"""Physical-plan properties that must hold at any scale."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_no_cross_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_exchanges_and_pruned_scans(spark):
    plan = _plan(entry.queries()["two_level_agg"](spark, SF_SMALL))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # level-1 distinct pairs, level-1 loans, links by loan, level-2 clients
    assert len(exchanges) <= 4
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lineitem = [s for s in scans if "l_orderkey" in s][0]
    assert "l_comment" not in lineitem and "l_returnflag" not in lineitem and "l_partkey" not in lineitem
    orders = [s for s in scans if "o_orderkey" in s][0]
    assert set(re.sub(r"#\d+L?", "", orders).split(",")) == {"o_orderkey", "o_custkey"}


def test_feature_table_shares_the_link_shuffle(spark):
    from riskweave.plans import features as feat
    from riskweave.plans import testdata_views as V
    plan = _plan(feat.build_feature_table(V.loan_tables(spark, SF_SMALL)))
    link_scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
                  if re.sub(r"#\d+L?", "", s) == "o_orderkey,o_custkey"]
    assert len(link_scans) == 1          # the (client, loan) links are read and shuffled once


def test_rows_are_shuffled_instead_of_wide_buffers(spark):
    from riskweave.operators import aggregate as agg
    plan = _plan(entry.queries()["link_join"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 1  # instalments by loan; the few links are broadcast
    rows = spark.createDataFrame([(1, 2.0)] * 5 + [(2, 1.0), (None, 1.0)], "k long, x double")
    assert "REPARTITION_BY_COL" in _plan(agg.rows_by_key(rows, "k"))
    assert "REPARTITION_BY_COL" not in _plan(agg.rows_by_key(rows, "k", hot_rows=4))  # a hot key is combined first


def test_selection_reads_the_features_once(spark, monkeypatch):
    from riskweave.operators import select as SEL

    class Seen(Exception):
        pass

    def seen(df, *args, **kwargs):
        raise Seen("InMemory" in _plan(df))
    monkeypatch.setattr(SEL, "remove_high_missing", seen)
    train = spark.createDataFrame([(1, 0, 0, 1.0), (2, 1, 1, 2.0)], "id long, fold int, y int, x double")
    with pytest.raises(Seen, match="True"):
        SEL.select_optimal_features(train, "y", "id")
