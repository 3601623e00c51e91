"""op3's model is of all proposals, whatever the number of their feature vectors."""

import pytest

from tripdemand.llm.pii import fit_proposals


def test_vectors_beyond_the_driver_are_fitted_by_spark(spark):
    rows = [(f"span {i}", i % 23, i * 7 % 31, (i % 23 > 11 and i % 10 > 0) or i * 7 % 31 < 4) for i in range(900)]
    rows += [("odd", 1, 1, None)]
    found = spark.createDataFrame(rows, "span string, f0 int, f1 int, proof boolean")
    whole, threshold = fit_proposals(found, ["f0", "f1"])
    table, by_spark = fit_proposals(found, ["f0", "f1"], train_rows=5)
    assert threshold < 1 and by_spark == pytest.approx(threshold, abs=1e-9)
    assert len(table.trees) == len(whole.trees) and table.base == pytest.approx(whole.base)
    for (root, leaves), (other, others) in zip(whole.trees, table.trees):
        assert root == other and [s for s, _ in leaves] == [s for s, _ in others]
        assert [v for _, vs in leaves for v in vs] == pytest.approx([v for _, vs in others for v in vs])
    nothing = fit_proposals(found.where("proof is null"), ["f0", "f1"], train_rows=0)
    assert nothing[1] == 1.1
