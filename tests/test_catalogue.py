"""Every query with a SQL counterpart agrees with DuckDB; the others give rows."""

import pytest

from shelfline.plans import load_all
from tests.compare import connect, difference

QUERIES, ORACLE = load_all()
# covered with fewer trees in test_models and test_attribution
SLOW = {"ml4_boosted_trees", "ml7_batch_scores", "ml8_feature_importance", "ml8_attributions", "ml8_global_attribution"}
WITHOUT_SQL = SLOW | {"io11_manifest", "io12_manifest_check", "io13_pending_files", "q_d6_pr_auc", "q_d8_risk_features", "rk1_logistic_risk"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, con, name):
    bad = difference(QUERIES[name](spark, sf), con, ORACLE[name])
    assert bad is None, bad


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, sf, name):
    """All columns are computed; a count would prune them."""
    df = QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    assert not df.isEmpty()


def test_entry_is_registered():
    assert "flagship_store_stockouts" in ORACLE
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


def test_risk_after_a_logged_run(spark, sf):
    """A run log leaves an observation manager in the session; scoring must not depend on the session."""
    for name in ("io14_run_log", "rk1_logistic_risk", "q_d6_pr_auc"):
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
