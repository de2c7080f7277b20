import random

from ledgerflow.llm.common import recording
from ledgerflow.llm.components import components


def brute(edges):
    least = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in least:
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    return least


def found(spark, edges):
    paths = []
    with recording(paths):
        got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert len(got) == len(set(got))
    return dict(got), [p.rsplit("/", 1)[1] for p in paths], paths


def test_components_match_brute_force_and_edges_never_get_more(spark):
    rng = random.Random(5)
    path = [100 + i for i in rng.sample(range(40), 40)]
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + list(zip(path, path[1:]))
    edges += [(300, i) for i in range(200, 230)] + [(i, 231) for i in range(215, 220)]  # a hub that is the largest
    edges += edges[:20] + [(b, a) for a, b in edges[20:40]] + [(7, 7), (None, 3), (500, 500)]
    got, names, paths = found(spark, edges)
    assert got == brute(edges)
    sizes = [spark.read.parquet(p).count() for p, n in zip(paths, names) if n in ("edges", "large")]
    assert all(n <= len(edges) for n in sizes)


def test_stars_are_done_in_one_pass(spark):
    edges = [(1, i) for i in range(10, 60)] + [(i, 2) for i in range(60, 90)] + [(2, 60)]
    got, names, _ = found(spark, edges)
    assert got == brute(edges)
    assert names == ["edges", "least"]


def test_no_edges(spark):
    assert found(spark, [])[:2] == ({}, ["edges", "least"])
