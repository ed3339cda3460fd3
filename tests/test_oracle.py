"""Every registered query with an oracle SQL agrees with DuckDB (the driver's gate), at sf0.001."""
import pytest

import __spark_entry__ as E
from .compare import compare
from .conftest import SF_SMALL

ORACLE = E.oracle_sql()
# hundreds of rounds at the reference's settings: the driver's gate runs them, tests/test_boosting.py their learners
SLOW = {"train_gbt_deep", "train_gbt_leafy", "train_gbt_balanced", "train_gbt", "train_gbt_hist", "model_comparison", "loss_curve"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_duckdb(spark, name):
    res = compare(E.queries()[name](spark, SF_SMALL), ORACLE[name], SF_SMALL)
    assert res["ok"], res


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1
    assert df.columns == ["tld", "n", "https_share", "mean_entropy"]
