"""Notes, links, graph, tags and time."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusgraph.operators import graph as G
from corpusgraph.operators import notes as N
from corpusgraph.operators import tags as A
from corpusgraph.operators import timefilter as TF
from corpusgraph.sources.notes import list_notes, read_notes, write_notes

BODIES = {
    "drops/First Note.md": "---\ntitle: x\ntags: [alpha, 'be ta']\ndate: 2020-01-02\n---\nintro\n# Real *Title*\n\nSee [[Second]] and [[Folder/Third|third one]] [[A#H]] #hash/tag http://e.x/#frag\n",
    "Folder/Third.md": "---\ntags:\n  - one\n  - two words\naliases: [t3, tre]\nupdated: now\n---\n\nback to [[first note]] and [[Second]] [[gone]]",
    "Other/Third.md": "no heading [[Third]]",
    "memory/Second.md": "---\nunterminated: yes\n# Sec\n[[drops/First Note]] [[Third]]",
    "C.md": "# C `code` [x]\n> [!NOTE] Hey there\n> line one\n>\n> [!tip] inside\nout\n> quote\n> [!Warning]\n> w\n#### four\n### Three-Part: Heading\n",
}


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(list(BODIES.items()), "path string, body string").withColumn(
        "modified_at", F.lit("2020-01-01").cast("timestamp")
    )


def test_parse(notes):
    got = {r.id: r for r in N.parse_notes(notes).collect()}
    first = got["drops/first-note"]
    assert (first.label, first.type, first.folder) == ("Real *Title*", "drop", "drops")
    assert first.tags == ["alpha", "be ta", "H", "hash/tag", "frag"]
    assert first.links == ["second", "folder/third"]
    assert first.excerpt == "intro See Second and Folder/Third|third one A#H #hash/tag http://e.x/#frag"
    third = got["folder/third"]
    assert (third.label, third.tags) == ("Third", ["one", "two words"])
    assert (got["memory/second"].type, got["c"].folder) == ("memory", "")
    bodies = {r.id: r.body for r in N.bodies(notes).collect()}
    assert bodies["drops/first-note"].startswith("intro  Real Title See Second and Folder/Third AH hash/tag")


def test_front_matter_headings_callouts(notes, rows):
    got = {r.path: r for r in N.front_matter_map(notes).collect()}
    assert set(got) == {"drops/First Note.md", "Folder/Third.md"}
    assert got["drops/First Note.md"].created == "2020-01-02"
    third = got["Folder/Third.md"]
    assert (third.tags, third.aliases, third.modified) == (["one", "two words"], ["t3", "tre"], "now")
    assert rows(N.headings(notes).filter("path = 'C.md'"), "pos", "level", "text", "anchor") == [
        (0, 1, "C code x", "c-code-x"), (10, 3, "Three-Part: Heading", "three-part-heading"),
    ]
    assert rows(N.callouts(notes), "pos", "type", "title", "lines") == [
        (1, "note", "Hey there", ["line one", "", "[!tip] inside"]), (7, "warning", "WARNING", ["w"]),
    ]


def test_links(notes, rows):
    nodes, links = N.build_graph(notes)
    # A bare name goes to the smallest id with that base name; mutual links count once.
    assert rows(links, "source", "target") == [
        ("drops/first-note", "folder/third"), ("drops/first-note", "memory/second"), ("folder/third", "memory/second"),
        ("other/third", "folder/third"),
    ]
    back = rows(N.backlinks(nodes), "id", "source")
    assert ("drops/first-note", "folder/third") in back and ("other/third", "memory/second") in back
    assert [r.id for r in G.resolve_node(nodes, "Third").collect()] == ["folder/third"]
    assert [r.id for r in G.resolve_node(nodes, "tag:alpha").collect()] == ["drops/first-note"]


def test_read_notes(spark, tmp_path, rows):
    for name, text in {"a b/x+y %41.md": "one", "a b/.hid/z.md": "no", ".top.md": "no", "k.txt": "no", "q.md": "#t"}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    assert rows(read_notes(spark, str(tmp_path)), "path", "body") == [("a b/x+y %41.md", "one"), ("q.md", "#t")]


def test_read_notes_sees_underscores_and_links(spark, tmp_path, rows):
    root, other = tmp_path / "notes", tmp_path / "other"
    for path, text in {root / "_drafts/_index.md": "é", root / "a/b/c/d.md": "deep", root / "_x.md": "", other / "far.md": "linked", other / "sub/z.md": "z"}.items():
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (root / "bad.md").write_bytes(b"ok \xff")
    (root / "link").symlink_to(other)
    (root / "file.md").symlink_to(other / "far.md")
    (root / "gone.md").symlink_to(other / "nothing.md")
    (other / "sub/loop").symlink_to(root)  # leads back to where it lies
    want = [("_drafts/_index.md", "é"), ("_x.md", ""), ("a/b/c/d.md", "deep"), ("bad.md", "ok \ufffd"), ("file.md", "linked"), ("link/far.md", "linked"), ("link/sub/z.md", "z")]
    for address in (str(root), f"file://{root}/", f"file:{root}"):
        assert rows(read_notes(spark, address), "path", "body") == want
    sizes = {r.path: (r["size"], r.modified_at is not None) for r in list_notes(spark, str(root)).collect()}
    assert sizes["a/b/c/d.md"] == (4, True)
    assert read_notes(spark, str(tmp_path / "nowhere")).count() == 0


def test_write_notes_and_read_back(spark, tmp_path, rows):
    notes = [(f"f{i % 3}/n {i}.md", "x" * i) for i in range(40)] + [("top.md", None)]
    frame = spark.createDataFrame(notes, "path string, body string").repartition(3)
    assert write_notes(frame, str(tmp_path)) == 41 and write_notes(frame, f"file://{tmp_path}") == 41
    got = rows(read_notes(spark, str(tmp_path), task_bytes=100), "path", "body")
    assert got == sorted(((p, b or "") for p, b in notes), key=repr)


def _graph(spark, edges, extra=()):
    ids = sorted({x for e in edges for x in e} | set(extra))
    nodes = spark.createDataFrame([(i, i[0], i) for i in ids], "id string, folder string, label string")
    return nodes, spark.createDataFrame(list(edges) or [], "source string, target string")


def _components(edges, ids):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.integers(0, 14), st.integers(0, 14)), min_size=1, max_size=14))
def test_components_random(spark, pairs):
    edges = [(f"n{a:02}", f"n{b:02}") for a, b in pairs if a < b]
    ids = [f"n{i:02}" for i in range(15)]
    nodes, links = _graph(spark, edges, ids)
    got = {r.id: r.component for r in G.components(nodes, links).collect()}
    assert got == _components(edges, ids)


def test_components_long_path_and_star(spark):
    path = [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)]
    star = [("s000", f"s{i:03}") for i in range(1, 40)]
    nodes, links = _graph(spark, path[::2] + path[1::2] + star, ["z"])
    got = {r.id: (r.component, r.size, r.is_largest) for r in G.components(nodes, links).collect()}
    assert got["p060"] == ("p000", 61, True) and got["s039"] == ("s000", 40, False) and got["z"] == ("z", 1, False)
    sizes = [(r.component, r.size, r.rank) for r in G.component_sizes(G.component_labels(links)).orderBy("rank").collect()]
    assert sizes == [("p000", 61, 1), ("s000", 40, 2)]


def test_paths(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "e"), ("e", "d"), ("x", "y"), ("f", "d"), ("a", "f")]
    _, links = _graph(spark, edges)

    def path(a, b, depth=None):
        return [r.id for r in G.shortest_path(links, a, b, depth).orderBy("step").collect()]

    assert path("a", "d") == ["a", "e", "d"]
    assert path("a", "a") == ["a"] and path("a", "y") == [] and path("a", "b") == ["a", "b"]
    assert path("b", "f", 1) == [] and path("b", "f", 2) == ["b", "a", "f"]


def test_degree_tiers_navigation(spark, rows):
    edges = [("h1", f"l{i:02}") for i in range(6)] + [("h2", f"l{i:02}") for i in range(6, 12)] + [("h1", "h2"), ("h1", "h3"), ("h2", "h3")]
    nodes, links = _graph(spark, edges, [f"o{i}" for i in range(5)])
    degrees = G.degree(nodes, links)
    assert degrees.agg(F.sum("degree")).first()[0] == 2 * len(edges)
    tiers = {r.id: r.tier for r in G.tiers(degrees, links).collect()}
    # Twenty nodes: rank 17 holds degree 2, so only the three hubs qualify.
    assert {k: v for k, v in tiers.items() if v != "regular"} == {"h1": "supernode", "h2": "supernode", "h3": "ultranode"}
    assert rows(G.orphans_by_folder(nodes, links)) == [("o", 5)]
    assert rows(G.folder_centre(nodes, degrees), "folder", "id") == [("h", "h1"), ("l", "l00"), ("o", "o0")]
    assert {r.id: r.neighbour for r in G.best_neighbour(links, degrees).collect()}["h3"] == "h1"
    assert rows(G.focus(links, "h3")) == [("h1",), ("h2",), ("h3",)]
    shut = spark.createDataFrame([("l",)], "folder string")
    left = G.collapse(nodes, G.folder_centre(nodes, degrees), shut)
    assert left.filter("id like 'l%'").count() == 1 and left.count() == 9
    seen, shown = G.visible_subgraph(nodes, links, left, G.focus(links, "h1"))
    assert rows(seen, "id") == [("h1",), ("h2",), ("h3",), ("l00",)] and shown.count() == 4


def _venn(spark):
    data = (
        [(f"a{i}", ["A", "B"]) for i in range(6)] + [(f"c{i}", ["C"]) for i in range(5)] + [(f"d{i}", ["C", "A"]) for i in range(2)]
        + [(f"e{i}", ["A", "B", "C"]) for i in range(3)] + [("z", ["rare"]), ("y", [])]
    )
    return spark.createDataFrame(data, "id string, tags array<string>")


def test_venn(spark, rows):
    nodes = _venn(spark)
    top = A.top_tags(nodes)
    assert rows(top) == [("A", 11), ("B", 9), ("C", 10)]
    pairs = A.tag_pairs(nodes, only=top)
    assert rows(pairs) == [("A", "B", 9), ("A", "C", 5), ("B", "C", 3)]
    box = {r.id: (r.box, r.matched) for r in A.venn_assign(nodes, top, pairs).collect()}
    assert box["a0"] == ("A∩B", 2) and box["c0"] == ("C", 1) and box["d0"] == ("A∩C", 2) and box["e0"] == ("A∩B", 3)
    assert box["z"] == ("", 0) and box["y"] == ("", 0)
    filled = {r.id: (r.box, r.matched) for r in A.venn_backfill(A.venn_assign(nodes, top, pairs), top).collect()}
    # A takes its first three nodes by id; B the next three of what is left.
    assert [i for i, b in sorted(filled.items()) if b == ("A", 1)] == ["a0", "a1", "a2"]
    assert [i for i, b in sorted(filled.items()) if b == ("B", 1)] == ["a3", "a4", "a5"]
    assert filled["d0"] == ("A∩C", 2)
    strict = {r.id: r.box for r in A.venn_assign(nodes, top, A.tag_pairs(nodes, 100, only=top)).collect()}
    assert strict["a0"] == "B" and strict["d0"] == "C" and strict["e0"] == "A"


def test_tag_filters(spark, rows):
    nodes = _venn(spark)
    assert A.tag_isolation(nodes, ["a", "C"]).count() == 5
    assert A.tag_isolation(nodes, ["a"], exact=True).count() == 11
    tags = spark.createDataFrame([("beta",), ("abet",), ("Bet",), ("x",)], "tag string")
    assert [r.tag for r in A.tag_suggest(tags, "#be").collect()] == ["Bet", "beta", "abet"]


def test_time(spark):
    df = spark.createDataFrame([(i,) for i in range(400)], "d int").selectExpr("timestamp'2024-03-31 12:00:00' - make_interval(0,0,0,d) AS created_at")
    counts = {r.preset: r.n for r in TF.preset_counts(df, "created_at", "2024-03-31 12:00:00").collect()}
    assert counts == {"1D": 2, "1W": 8, "1M": 32, "1Y": 367, "ALL": 400}
    for preset, n in counts.items():
        assert TF.time_filter(df, "created_at", preset, "2024-03-31 12:00:00").count() == n
    for step in (1, 7, 20):
        frames = TF.timelapse(df, "created_at", step).orderBy("frame").collect()
        totals = [f.n_total for f in frames]
        assert totals == sorted(totals) and totals[-1] == 400 and frames[0].n_total == 1
        assert frames[-1].frame_end == df.agg(F.max("created_at")).first()[0]
