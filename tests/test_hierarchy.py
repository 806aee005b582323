import random

from lodestrata.operators.hierarchy import descendants, lineages


def reference(nodes, links):
    parent = {}
    for t, n, p in links:
        if n is not None and p is not None:
            parent[t, n] = min(p, parent.get((t, n), p))
    out = {}
    for t, n in nodes:
        if n is None:
            continue
        path = [n]
        while (t, path[-1]) in parent and path[-1] not in path[:-1]:
            path.append(parent[t, path[-1]])
        out[t, n] = ("", -1, "") if path[-1] in path[:-1] else (path[-1], len(path) - 1, " > ".join(path[::-1]))
    return out


def run(spark, nodes, links):
    found = lineages(spark.createDataFrame(nodes, "tab string, node string"), spark.createDataFrame(links, "tab string, node string, parent string"))
    return found, {(r["tab"], r["node"]): (r["root"], r["depth"], r["path"]) for r in found.collect()}


def test_random_forests_and_loops(spark):
    rng = random.Random(3)
    for size in (1, 30, 400):
        nodes = [(rng.choice("ab"), f"n{i}") for i in range(size)] + [("a", None), ("a", "n0"), ("a", "n0")]
        links = [(t, n, rng.choice(["n0", f"n{rng.randrange(size)}", f"n{rng.randrange(size + 5)}", None])) for t, n in nodes if rng.random() < 0.8]
        assert run(spark, nodes, links)[1] == reference(nodes, links)


def test_long_chain_star_and_loop(spark):
    nodes = [("a", f"c{i:03}") for i in range(150)] + [("a", f"s{i}") for i in range(200)] + [("a", x) for x in "xyz"]
    links = [("a", f"c{i:03}", f"c{i + 1:03}") for i in range(149)] + [("a", f"s{i}", "c005") for i in range(200)] + [("a", "x", "y"), ("a", "y", "x"), ("a", "z", "y")]
    found, out = run(spark, nodes, links)
    assert out == reference(nodes, links) and out["a", "c000"][1] == 149 and out["a", "z"] == ("", -1, "")
    below = {(r["node"], r["descendant"]): r["distance"] for r in descendants(found).collect()}
    assert below["c149", "c000"] == 149 and below["c006", "s7"] == 2 and len(below) == sum(d for _, d, _ in out.values() if d > 0)


def test_empty(spark):
    assert run(spark, [], [])[1] == {}
