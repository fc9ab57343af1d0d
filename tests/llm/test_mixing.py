"""Raking runs until the marginals are met, or says that they cannot be."""

import pytest
from pyspark.sql import functions as F

from staywise.llm import mixing

CELLS = "source string, lang string, topic string, tokens long"


def test_slow_targets_are_met_exactly(spark):
    # Cells that hardly overlap: some thirty sweeps.
    rows = [("a", "en", "t", 1000), ("a", "de", "t", 500), ("b", "de", "t", 1000), ("b", "fr", "t", 500), ("c", "fr", "t", 1000), ("c", "en", "t", 500)]
    weights = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.25, "de": 0.35, "fr": 0.4}, "topic": {"t": 1.0}}
    raked = mixing.rake(spark.createDataFrame(rows, CELLS), mixing.Targets(weights=weights))
    for name in ("source", "lang"):
        sums = {r[0]: r[1] for r in raked.groupBy(name).agg(F.sum("weight")).collect()}
        assert sums == pytest.approx(weights[name], abs=1e-8)


def test_targets_that_cannot_be_met_raise(spark):
    rows = [("a", "en", "t", 100), ("b", "de", "t", 100)]
    weights = {"source": {"a": 0.2, "b": 0.8}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"t": 1.0}}
    with pytest.raises(ValueError, match="cannot be met together"):
        mixing.rake(spark.createDataFrame(rows, CELLS), mixing.Targets(weights=weights), stalled=4)


def test_no_cells_give_none(spark):
    assert mixing.rake(spark.createDataFrame([], CELLS)).count() == 0
