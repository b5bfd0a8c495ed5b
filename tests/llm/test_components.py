import random

from pulselake.llm import components, parity_join
from pulselake.llm.components import connected_components, grown_components


def brute(edges):
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    ends = {x for a, b in edges if a != b for x in (a, b)}
    return sorted((x, find(x)) for x in ends)


def graph(spark, edges):
    return spark.createDataFrame(edges, "a long, b long").repartition(3)


def found(labels):
    return sorted(map(tuple, labels.collect()))


def samples():
    rng = random.Random(4)
    path = list(range(60))
    rng.shuffle(path)
    yield [*zip(path, path[1:]), (900, 900)]
    yield [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] * 2
    yield [(500, x) for x in range(-40, 40)] + [(x, 600) for x in range(30, 50)]


def test_components_and_further_edges(spark):
    for edges in samples():
        assert found(connected_components(graph(spark, edges))) == brute(edges)
        for at in (3, len(edges) // 2, len(edges)):
            before = connected_components(graph(spark, edges[:at]))
            # Edges known before change nothing, and no further edge is none.
            after = grown_components(before, graph(spark, edges[at // 2 :]))
            assert found(after) == brute(edges)


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(" Exchange " in line and "ReusedExchange" not in line for line in plan.splitlines())


def test_rounds_are_few_and_narrow(spark, monkeypatch):
    """Stars take no round, and a round has four exchanges."""
    sizes = []
    stored = components.stored

    def seen(df, purpose, *rest):
        sizes.append(exchanges(df))
        return stored(df, purpose, *rest)

    monkeypatch.setattr(components, "stored", seen)
    stars = [(10 * (x % 7), 10 * (x % 7) + 1 + x // 7) for x in range(60)]
    assert found(connected_components(graph(spark, stars))) == brute(stars)
    assert len(sizes) == 1
    path = [(x, x + 1) for x in range(20)]
    assert found(connected_components(graph(spark, path))) == brute(path)
    assert max(sizes[2:]) <= 4


def test_links_known_before_are_not_joined_again(spark, monkeypatch):
    """Later rounds of the join get edges between components only."""
    from test_parity_join import brute as by_pairs
    from test_parity_join import crowded, got

    asked = []
    whole = components.stars

    def seen(edges):
        asked.append(edges.where("a <> b").select("a", "b").distinct().count())
        return whole(edges)

    linked = []
    links = parity_join.Join.links

    def counted(self, near):
        out = links(self, near)
        linked.append(out.count())
        return out

    monkeypatch.setattr(components, "stars", seen)
    monkeypatch.setattr(parity_join.Join, "links", counted)
    docs = crowded(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(frame) == by_pairs(docs)
    assert len(asked) == len(linked) > 2
    assert all(n <= m for n, m in zip(asked, linked, strict=True))
