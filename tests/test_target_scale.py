"""Link targets are looked up once; results are checked against plain rules."""

from corpusgraph.operators import notes as N


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_links_are_resolved_once_a_target(spark):
    nodes = spark.createDataFrame(
        [("f/a", ["b", "f/a", "none", "g/b", "b"]), ("g/b", ["f/a", "x/a"]), ("h/b", ["a", "g/b"]), ("a", ["f/a"])], "id string, links array<string>"
    )
    found = {(r.source, r.target, r.pos) for r in N.resolve_targets(N.raw_links(nodes), nodes).collect()}
    assert found == {
        ("f/a", "g/b", 0), ("f/a", "g/b", 3), ("g/b", "f/a", 0), ("g/b", "a", 1), ("h/b", "a", 0), ("h/b", "g/b", 1), ("a", "f/a", 0),
    }
    links = N.build_links(nodes)
    assert sorted(tuple(r) for r in links.collect()) == [("a", "f/a"), ("f/a", "g/b"), ("g/b", "a"), ("h/b", "a"), ("h/b", "g/b")]
    assert "Window" not in _plan(links)
