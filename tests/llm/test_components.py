import random

from lakeloom.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(500, 560)] + [(900, k) for k in range(901, 960)]
    edges += [(None, 3), (7, 7), (5, None)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        return x if up[x] == x else root(up[x])

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "src long, dst long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, root(x)) for x in list(up))
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")) is None
