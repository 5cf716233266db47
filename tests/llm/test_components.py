import random

import brute

from goldquarry.llm.components import connected_components


def test_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3), (3, 9)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(220)]
    edges += edges[:20]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    plain = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == brute.components({x for e in plain for x in e}, plain)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
