"""Paths beyond the checked sizes: nothing counts as small, every key as hot."""

import pytest

from compare import TESTDATA, connect, differences
from shopstar.config import sample_config
from shopstar.plans import oracle, registry
from shopstar.plans.warehouse import sample_warehouse

CFG = sample_config().with_(broadcast_rows=0, skew_min_rows=1, basket_block=7)

NAMES = (
    "clean_sales", "quarantine", "dim_branch", "dim_product", "dim_payment", "dim_customer",
    "fact_sales", "rfm_segment", "basket_affinity", "customer_new_vs_returning",
    "customer_value_deciles", "product_abc_skus", "product_abc_summary", "product_cross_category",
    "dq_no_orphans", "page_product_pareto", "page_customer_segments", "page_exec_region_matrix",
    "page_branch_scorecard", "sig_top20_share", "measure_segment_profit", "measure_time_by_region",
)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_same_result(no_broadcast, name):
    wh = sample_warehouse(no_broadcast, f"{TESTDATA}/sf0.001", CFG)
    df = registry.operators()[name](wh)
    assert differences(df, connect("sf0.001"), oracle.oracle_sql()[name]) == []
