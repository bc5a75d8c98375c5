"""Registered queries against their DuckDB oracle SQL on the smallest driver tables."""

import math
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
NAMES = ["f_text_features", "a6_a7_correlations", "a4_impute", "a10_a11_chi_square", "a12_anova",
         "f5_f21_record_features", "w3_pr_curve", "a20_a22_curve_areas", "m14_threshold_search",
         "n2_n5_ensembles", "n7_n9_submission", "w5_stratified_folds", "s7_exact_sample",
         "v6_scaled_embeddings", "j5_knn_within_chunks", "m9_knn_classifier", "v14_weighted_resample"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    import os
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    from tessera.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    sdf = e.queries()[name](spark, SF)
    res = duck.execute(e.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = [dcols.index(c) for c in sdf.columns]
    drows = Counter(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
    srows = Counter(tuple(_norm(x) for x in r) for r in sdf.collect())
    assert srows == drows
