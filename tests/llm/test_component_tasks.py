"""Connecting few edges takes few tasks, connecting more takes more."""

from __future__ import annotations

import pytest

from murmuro.llm import jaccard_join


@pytest.mark.parametrize("per_task,most", [(50_000, 3), (300, 7)])
def test_tasks_go_with_the_edges(spark, monkeypatch, per_task, most):
    monkeypatch.setattr(jaccard_join, "TASK_EDGES", per_task)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # Chains of seven nodes, one star, one edge twice.
        pairs = [(i, i + 1) for i in range(2_100) if i % 7 != 6] + [(5_000, 5_000 + i) for i in range(1, 200)] + [(0, 1)]
        found = jaccard_join.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
        assert most - 2 <= len(found.inputFiles()) <= most
        got = dict(map(tuple, found.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 7 for i in range(2_100)} | {5_000 + i: 5_000 for i in range(200)}
