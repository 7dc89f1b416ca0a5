import random

from conftest import rows

from doclathe.operators.components import components


def expected(links):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return sorted(((x, top(x)) for x in parent), key=repr)


def check(spark, links):
    assert rows(components(spark.createDataFrame(links, "a long, b long, id int"))) == expected([x[:2] for x in links])


def test_random_graphs(spark):
    rng = random.Random(5)
    check(spark, [(rng.randrange(120), rng.randrange(120), 0) for _ in range(90)])


def test_long_path_star_and_odd_links(spark):
    check(spark, [(i, i + 1, 0) for i in range(200)] + [(1000, 1000 + i, 0) for i in range(1, 400)] + [(5, 5, 0), (77, 77, 0), (900, 900, 0), (None, 3, 0), (3, 4, 0), (4, 3, 0)])


def test_no_links(spark):
    check(spark, [])
