"""Plan checks: no cartesian products, one scan for the
single-aggregate profiles."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SINGLE_SCAN = ["missing_profile", "table_info", "corr_matrix_lineitem", "null_total", "vote_weighted_grid",
               "random_search_candidates"]


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SINGLE_SCAN)
def test_single_scan(spark, name):
    assert len(re.findall(r"FileScan parquet", _plan(spark, name))) == 1


@pytest.mark.parametrize("name", ["survival_by_price_bin", "stratified_split_orders", "roc_auc_by_model",
                                  "threshold_sweep_by_model", "knn_embeddings_k_sweep", "validate_submission",
                                  "forward_fill_by_user", "label_encode_union"])
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in _plan(spark, name)


def test_scan_prunes_columns(spark):
    p = _plan(spark, "select_numeric_features")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "o_orderpriority" not in schema and "o_orderdate" not in schema
