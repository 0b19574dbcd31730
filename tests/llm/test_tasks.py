"""What the driver has to keep: tasks and stages of the helpers that work in rounds."""

import random

import pytest
from pyspark.sql import functions as F

from phasewise.llm import common


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def reachable(links):
    """The smallest node of each node's component, by union and find."""
    up = {n: n for link in links for n in link}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for u, v in links:
        a, b = sorted((top(u), top(v)))
        up[b] = a
    return {n: top(n) for n in up}


def test_rounds_over_few_links_start_few_tasks(spark, many_partitions):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 440)] + [(900, 900)]
    spark.sparkContext.setJobGroup("components", "rounds")
    try:
        edges = spark.createDataFrame(links, "u long, v long").repartition(3)
        found = {r.node: r.component for r in common.components(edges).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == reachable(links)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    tasks = [info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s))]
    assert sum(n >= 97 for n in tasks) <= sum(n > 0 for n in tasks) / 4, sorted(tasks)


def test_links_are_worked_out_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        calls.add(1)
        return n

    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 5)], "u long, v long").select(counted("u").alias("u"), "v")
    found = common.components(edges)
    assert sorted(map(tuple, found.union(found).distinct().collect())) == [(1, 1), (2, 1), (3, 1), (5, 5)]
    assert calls.value == 3
