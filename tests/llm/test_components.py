"""Connected components against a plain union of sets, and the size of the tables they write."""

import random

import pytest
from tessera.llm._components import _left_to_do, connected_components
from tessera.plans import write_through

SCHEMA = "a bigint, b bigint"


@pytest.fixture(scope="module")
def wide(spark):
    """A session with many more shuffle partitions than tasks run at once, which are not put together again."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", str(3 * spark.sparkContext.defaultParallelism))
    return own


def brute(edges):
    root = {n: n for e in edges if e[0] != e[1] for n in e}
    while True:
        before = dict(root)
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if before == root:
            return sorted(root.items())


def test_small_tables_are_few_files(wide):
    rnd, at_once = random.Random(3), wide.sparkContext.defaultParallelism
    edges = [(rnd.randrange(3000), rnd.randrange(3000)) for _ in range(2500)] + [(5000 + i, 5000) for i in range(1000)]
    edges += [(9000 + i, 9001 + i) for i in range(40)] + [(7, 7)]
    found = connected_components(wide.createDataFrame(edges, SCHEMA), len(edges))
    assert len(found.inputFiles()) <= at_once
    assert sorted(tuple(r) for r in found.collect()) == brute(edges)
    found = connected_components(wide.createDataFrame(edges, SCHEMA))
    assert len(found.inputFiles()) <= at_once
    assert sorted(tuple(r) for r in found.collect()) == brute(edges)


def test_large_tables_keep_their_tasks(wide):
    df = wide.range(1000).selectExpr("id % 500 AS a").groupBy("a").count()
    assert len(write_through(df, rows=1000).inputFiles()) <= wide.sparkContext.defaultParallelism
    assert len(write_through(df, rows=10**9).inputFiles()) > wide.sparkContext.defaultParallelism
    assert write_through(df, rows=0).count() == 500


@pytest.mark.parametrize("edges, left", [
    ([], (0, False)), ([(2, 1)], (1, False)), ([(2, 1), (3, 1)], (2, False)), ([(2, 1), (4, 3)], (2, False)),
    ([(2, 1), (3, 2)], (2, True)), ([(3, 1), (3, 2)], (2, True)), ([(3, 1), (4, 1), (5, 4)], (3, True))])
def test_stars_are_the_end(spark, edges, left):
    """No further round once all components are stars."""
    assert _left_to_do(spark.createDataFrame(edges, SCHEMA)) == left
