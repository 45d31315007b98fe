import random

from cases import union_find

from contentmart.llm.common import components


def check(spark, links):
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == union_find(nodes, links)


def test_random_graph_with_loops_and_repeats(spark):
    rnd = random.Random(1)
    check(spark, [(rnd.randrange(300), rnd.randrange(300)) for _ in range(260)] + [(5, 5), (1, 2), (2, 1)])


def test_path_star_and_negative_nodes(spark):
    check(spark, [(i, i + 1) for i in range(-20, 20)] + [(1000, i) for i in range(1001, 1100)])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []
