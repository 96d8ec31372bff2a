"""Every query on the smallest tables, against its SQL where it has one."""

import os

import pytest

import __spark_entry__ as entry
import compare

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.database(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare.difference(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_plans_have_no_slow_shapes(spark):
    """No row-at-a-time Python, no pair-building join, no one-task window."""
    for name in ("scan_lines", "quantile_transform", "nb_gaussian", "kmeans", "vocabulary", "tfidf_tfidf", "restore_diacritics",
                 "knn_join", "bootstrap_counts", "fbeta_correlation", "stratified_folds", "char_ngrams", "macro_f1"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for shape in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert shape not in plan, (name, shape)
        for line in plan.splitlines():
            if " Window [" in line or line.strip().startswith("Window ["):
                assert "windowspecdefinition(" in line and ", [" in line, (name, line)
        assert "Exchange SinglePartition" not in plan or name == "macro_f1", name


def test_fits_take_all_columns_and_iterations(spark, monkeypatch):
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    models = []
    for kind in (LinearSVC, LogisticRegression):
        def fitted(self, df, fit=kind._fit):
            models.append(fit(self, df))
            return models[-1]
        monkeypatch.setattr(kind, "_fit", fitted)
    for name in ("svm_fit", "logistic_fit"):
        entry.queries()[name](spark, SF)
    assert [(m.numFeatures, m.getMaxIter()) for m in models] == [(64, 100)] * 2
