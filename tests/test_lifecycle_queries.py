"""The policy's whole search runs, and the training queries return what their SQL says."""

import check
import pytest

from riskmart.config import Policy
from riskmart.operators import training
from riskmart.plans import catalog
from riskmart.plans import lifecycle_queries as lq


def test_the_whole_search_of_a_slot(spark, sf):
    """All draws, folds and sizes of the policy, both algorithms."""
    slot, data, columns = lq.prepared_slots(spark, sf)[1]
    train = data.where("role = 'train'")
    for algorithm in (training.LOGISTIC, training.TREES):
        tried = training.search(train, algorithm, columns, Policy())
        assert [t["params"] for t in tried] == training.draws(algorithm, Policy().search_draws, Policy().seed)
        assert all(set(t["fold_aucs"]) == {1, 2, 3} for t in tried)


@pytest.mark.parametrize("name", ["train_logistic", "train_boosted_trees", "feature_importance", "batch_score"])
def test_query_and_sql(spark, name):
    # 0.01: the smallest tables have too few applicants with clicks
    folder = "/root/testdata/sf0.01"
    message, *_ = check.compare(spark, check.connect(folder), name, catalog.all_queries()[name], catalog.all_oracles()[name], folder)
    assert message is None
