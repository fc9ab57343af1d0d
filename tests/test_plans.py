"""Properties of the physical plans that matter at scale."""

from datetime import timedelta

import pytest

from __spark_entry__ import queries
from staywise.operators.rfm import transaction_windows
from staywise.plans import frames
from staywise.session import work_folder

LAZY = ("rfm_windows", "engagement_windows", "score_customers", "feature_lookup", "feature_lookup_asof", "score_dedup",
        "confusion_matrix", "feature_upsert", "customer_features", "snapshot_features")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_stage_no_cross_join_no_single_task_exchange(spark, folder, name):
    plan = plan_of(queries()[name](spark, folder))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert word not in plan, word


@pytest.mark.parametrize("build", (frames.scored_inputs, frames.labelled))
def test_parts_are_read_only_for_categories(spark, folder, build):
    assert "part.parquet" not in plan_of(build(spark, folder))


def test_transaction_windows_scan_once_and_shuffle_three_times(spark, folder):
    df = transaction_windows(frames.history(spark, folder), frames.AS_OF)
    plan = plan_of(df)
    assert plan.count("lineitem.parquet") == 1 and plan.count("Exchange hashpartitioning(customer_id") == 3
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_work_folder_is_read_from_the_session(spark):
    before = work_folder(spark)
    assert work_folder(spark) == before
    assert frames.LABEL_DATE == frames.AS_OF - timedelta(days=90)


class _Cluster:
    """A session on a cluster without a shared folder."""

    class _Settings(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    def __init__(self):
        self.conf = self._Settings()
        self.sparkContext = self
        self.master = "spark://host:7077"

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        work_folder(_Cluster())
