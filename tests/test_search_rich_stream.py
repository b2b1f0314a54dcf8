"""Search, vectors, rich text, posts and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgraph.functions.scale import discard
from corpusgraph.operators import corpus as C
from corpusgraph.operators import richtext as RT
from corpusgraph.operators import search as S
from corpusgraph.operators import vectors as V
from corpusgraph.sources import posts as P
from corpusgraph.sources import tables as TB
from corpusgraph.streaming import jobs as J


def _nodes(spark):
    return spark.createDataFrame(
        [("a/one", "Tarn Flood", ["water", "News"], "river rose"), ("b/two", "Other", ["tarn"], "flood again"), ("c", "Quiet", [], "none")],
        "id string, label string, tags array<string>, excerpt string",
    )


def test_scores_and_box(spark, rows):
    nodes = _nodes(spark)
    assert rows(S.term_search(nodes, "Tarn #news one"), "id", "score") == [("a/one", 23), ("b/two", 8), ("c", 3)]
    assert rows(S.box_search(nodes, "#wat flood")) == [("a/one",)]
    assert rows(S.box_search(nodes, "flood")) == [("a/one",), ("b/two",)]
    hits = spark.createDataFrame([("a/one", 1.0), ("new", 2.0)], "id string, score double")
    assert rows(S.enrich(hits, nodes), "id", "label", "excerpt") == [("a/one", "Tarn Flood", "river rose"), ("new", "new", "")]


def test_full_text(spark):
    docs = spark.createDataFrame(
        [("1", "Flood plains", "the river flooded the flood plain"), ("2", "River", "floor and flod"), ("3", "Else", "nothing, here")],
        "id string, title string, content string",
    )
    index = S.build_index(docs)
    forms = {(r.term): round(r.weight, 4) for r in S.expand_terms(index, "Flood!").collect()}
    assert forms == {"flood": 1.0, "flooded": round(0.375 * 5 / 5.6, 4), "flod": round(0.45 * 5 / 6, 4), "floor": round(0.45 * 5 / 6, 4)}
    hits = [r.id for r in S.bm25(index, "flood").collect()]
    assert hits == ["1", "2"]
    assert [r.id for r in S.bm25(index, "flood", fuzzy=0, prefix=False).collect()] == ["1"]
    assert S.bm25(index, "...").count() == 0
    text = spark.createDataFrame([("x" * 60 + " Flood of mark " + "y" * 100,), ("short flood",), ("none",)], "b string")
    got = [r[0] for r in text.select(S.snippet(F.col("b"), "mark flood")).collect()]
    assert got[0].startswith("…x") and "<mark>Flood</mark> of <mark>mark</mark>" in got[0] and got[0].endswith("…")
    assert got[1:] == ["short <mark>flood</mark>", "none"]


def test_index_finds_every_misspelt_term(spark):
    rng = np.random.default_rng(5)
    letters = "abcé"
    words = {"".join(letters[i] for i in rng.integers(0, 4, n)) for n in rng.integers(1, 14, 700)}
    index = S.build_index(spark.createDataFrame([("1", " ".join(sorted(words)))], "id string, content string"), ("content",))

    def apart(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for word in [*sorted(words)[::60], "zabc", "abcabcabcabcabc"]:
        reach = int(0.2 * len(word) + 0.5)
        want = {w for w in words if w == word or apart(word, w) <= reach}
        assert {r.term for r in S.expand_terms(index, word, prefix=False).collect()} == want
    with pytest.raises(ValueError):
        S.expand_terms(index, "abc", fuzzy=0.5)


def test_search_reads_only_the_parts_that_hold_its_terms(spark):
    docs = spark.range(3000).selectExpr("CAST(id AS string) AS id", "concat('w', id % 1000, ' common v', id) AS content")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = S.build_index(docs, ("content",))
        assert index.postings.select("part").distinct().count() > 1
        hits = S.bm25(index, "w77", fuzzy=0, prefix=False)
        assert sorted(r.id for r in hits.collect()) == ["1077", "2077", "77"]
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruningexpression(part" in plan
        looked = S.expand_terms(index, "w77")._jdf.queryExecution().executedPlan().toString()
        assert "StringStartsWith(term,w77)" in looked and "In(piece" in looked
        # A term of every document lies in several parts and is still counted once.
        assert index.terms.filter("term = 'common'").count() > 1
        assert S.bm25(index, "common", None, fuzzy=0, prefix=False).count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cosine_against_numpy(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 8)).round(1)
    m[7] = m[9]
    m[11] = 0
    vecs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<float>").repartition(5)
    queries = vecs.filter("id < 9").select(F.col("id").alias("query_id"), "vec")
    unit = m.astype(np.float32).astype(float)
    norm = np.linalg.norm(unit, axis=1)
    for tiles in ({}, {"tile": 7, "query_tile": 2}, {"tile": 7, "query_tile": 2, "shards": 3}):
        got = {}
        for r in V.cosine_topk(vecs, queries, 5, **tiles).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
        for q in range(9):
            scores = [(i, float(unit[i] @ unit[q] / norm[i] / norm[q])) for i in range(60) if i != 11]
            want = sorted(((i, round(s, 9)) for i, s in scores), key=lambda t: (-t[1], t[0]))[:5]
            assert got[q] == want
    ids = spark.createDataFrame([(7,)], "id long")
    assert V.similar(vecs, ids, 3).orderBy("rank").first().id == 9


def test_embedding_refresh(spark):
    cache = spark.createDataFrame(
        [("same", 1, "m", 1, [9.0]), ("old", 1, "m", 1, [9.0]), ("bad", 1, "m", 1, [9.0]), ("gone", 1, "m", 1, [9.0])],
        "id string, mtime long, model string, version int, vec array<float>",
    )
    notes = spark.createDataFrame([("same", 1, "l", "c"), ("old", 2, "l", "c"), ("bad", 2, "boom", "c"), ("new", 1, "l", "c")], "id string, mtime long, label string, content string")
    inner = V.hashed_embedder(16)

    def embedder(texts):
        if any("boom" in t for t in texts):
            raise ValueError
        return inner(texts)

    got = {r.id: (r.mtime, len(r.vec)) for r in V.refresh_embeddings(cache, notes, embedder, "m").collect()}
    # A failed note keeps its old vector.
    assert got == {"same": (1, 1), "old": (2, 16), "bad": (1, 1), "new": (1, 16)}


def test_embedding_cache_guard(spark, tmp_path):
    cache = spark.createDataFrame([("a", "m", 1), ("b", "m", 2), ("c", "n", 1)], "id string, model string, version int")
    V.save_embeddings(cache, str(tmp_path / "e"))
    kept = V.load_embeddings(spark, str(tmp_path / "e"), "m", 1)
    assert [r.id for r in kept.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull" in kept._jdf.queryExecution().executedPlan().toString()


TREE = {
    "root": {
        "type": "root",
        "children": [
            {"type": "heading", "tag": "h2", "children": [{"type": "text", "text": " Plan "}]},
            {"type": "paragraph", "children": [
                {"type": "text", "text": "bold", "format": 1}, {"type": "linebreak"},
                {"type": "link", "fields": {"url": "https://news.example/known"}, "children": [{"type": "text", "text": "he", "format": 2}, {"type": "text", "text": "re"}]},
                {"type": "autolink", "fields": {"url": "https://o.example/x"}, "children": []},
                {"type": "odd", "text": "!"},
            ]},
            {"type": "list", "listType": "number", "children": [
                {"type": "listitem", "children": [{"type": "text", "text": "one"}, {"type": "list", "children": [{"type": "listitem", "children": [{"type": "text", "text": "in"}]}]}]},
                {"type": "listitem", "children": [{"type": "text", "text": "two"}]},
            ]},
            {"type": "horizontalrule"},
            {"type": "upload", "value": {"url": "/a.png", "alt": "pic"}},
            {"type": "block", "fields": {"content": {"root": {"type": "root", "children": [{"type": "quote", "children": [{"type": "text", "text": "said"}]}]}}}},
            {"type": "box", "children": [{"type": "paragraph", "children": [{"type": "text", "text": "boxed"}]}]},
            {"type": "text", "text": "loose"},
        ],
    }
}


def test_rich_text(spark, rows):
    deep = {"type": "text", "text": "deep"}
    for _ in range(600):
        deep = {"type": "x", "children": [deep]}
    deep = {"root": {"type": "root", "children": [{"type": "paragraph", "children": [deep]}]}}
    posts = spark.createDataFrame([(1, json.dumps(TREE)), (2, None), (3, "{}")], "doc_id long, content string")
    nodes = RT.rt_nodes(posts)
    assert rows(RT.richtext_text(nodes), "doc_id", "text") == [
        (1, "Plan bold he re one in two boxed loose"), (2, ""), (3, ""),
    ]
    blocks = RT.richtext_blocks(nodes).orderBy("block").collect()
    assert [(b.type, b.level, b.item, b.text, b.marks) for b in blocks] == [
        ("heading", 2, None, "Plan", 0), ("paragraph", None, None, "bold\nhere!", 3), ("listitem", None, 1, "onein", 0), ("listitem", None, 2, "two", 0),
        ("horizontalrule", None, None, "", 0), ("upload", None, None, "", 0), ("quote", None, None, "said", 0), ("paragraph", None, None, "boxed", 0),
    ]
    assert (blocks[5].url, blocks[5].alt, blocks[2].ordered) == ("/a.png", "pic", True)
    assert rows(RT.richtext_links(nodes), "url", "label") == [
        ("https://news.example/known", "here"), ("https://o.example/x", "https://o.example/x"),
    ]
    deep_posts = spark.createDataFrame([(1, json.dumps(deep))], "doc_id long, content string")
    assert RT.richtext_text(RT.rt_nodes(deep_posts)).first().text == "deep"


def test_posts(spark, tmp_path, rows):
    posts = [
        {"id": 1, "slug": "a", "title": "A", "content": TREE, "publishedAt": "2020-01-02", "categories": [{"id": 8, "title": "News"}, "Plain", None],
         "populatedAuthors": [{"name": "Ada"}, {"title": "Ed"}], "tags": [{"title": "two words"}], "relatedPosts": [{"slug": "b", "title": "B!"}, 5], "site": "s", "_status": "published", "excerpt": " x\n\ny "},
        {"id": 2, "slug": "b", "title": "B", "publishedAt": "2020-01-03", "categories": None, "authors": ["Bo"], "site": "s", "_status": "published"},
        {"id": 3, "slug": "c", "site": "s", "_status": "draft"}, {"id": 4, "slug": "d", "site": "t", "_status": "published", "publishedAt": "2021"},
    ]
    (tmp_path / "posts.json").write_text(json.dumps(posts))
    got = {r.doc_id: r for r in P.normalise_posts(P.read_posts(spark, str(tmp_path / "posts.json"))).collect()}
    assert (got[1].categories, got[1].authors, got[1].tags, got[1].excerpt) == (["News", "Plain"], ["Ada", "Ed"], ["two-words"], "x y")
    assert got[1].category_ids == [8] and [(r.slug, r.title) for r in got[1].related] == [("b", "B!")]
    assert (got[2].categories, got[2].authors, got[2].related) == ([], ["Bo"], [])
    text = RT.richtext_text(RT.rt_nodes(P.normalise_posts(P.read_posts(spark, str(tmp_path / "posts.json")))))
    assert rows(text.filter("doc_id = 1"), "text") == [("Plan bold he re one in two boxed loose",)]
    pages = tmp_path / "pages"
    pages.mkdir()
    for i in (0, 2):
        (pages / f"{i}.json").write_text(json.dumps({"docs": posts[i : i + 2], "totalPages": 2, "totalDocs": 4, "hasNextPage": i == 0}))
    assert [r.id for r in P.read_pages(spark, str(pages)).collect()] == [4, 2, 1]
    assert [r.id for r in P.read_pages(spark, str(pages), site="s", limit=1).collect()] == [2]
    names = spark.createDataFrame([("b", "Note B")], "slug string, note string")
    assert rows(C.related_posts(P.normalise_posts(P.read_posts(spark, str(tmp_path / "posts.json"))), names), "doc_id", "related") == [(1, "Note B")]


def test_sinks(spark, tmp_path, rows):
    index = spark.createDataFrame([("Cases/a.md", 1), ("People/b.md", 1)], "path string, rank int")
    TB.write_event_index(index, str(tmp_path / "ix"))
    assert rows(TB.read_note_events(spark, str(tmp_path / "ix"), "People/b.md"), "path") == [("People/b.md",)]
    assert TB.read_note_events(spark, str(tmp_path / "ix"), "Nowhere/x.md").count() == 0
    timeline = spark.sql("SELECT 'k' AS case, 'k note' AS note, 1 AS article_count, '2020' AS span, 0 AS page, array(struct('2020' AS date)) AS events")
    TB.write_timelines(timeline, str(tmp_path / "tl"))
    assert spark.read.json(str(tmp_path / "tl")).first().articleCount == 1


def test_streams_restart_and_equal_batch(spark, tmp_path, rows):
    schema = "id long, kind string, ts timestamp"
    first = spark.sql("SELECT 1L AS id, 'a' AS kind, timestamp'2024-01-01 01:00:00' AS ts UNION ALL SELECT 2, 'a', timestamp'2024-01-01 02:00:00'")
    second = spark.sql("SELECT 1L AS id, 'b' AS kind, timestamp'2024-01-02 01:00:00' AS ts UNION ALL SELECT 3, 'a', timestamp'2024-01-01 03:00:00'")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for batch in (first, second):
        batch.write.mode("append").parquet(src)
        order = [F.desc("ts")]
        J.stream_upsert(spark.readStream.schema(schema).parquet(src), f"{out}/u", "id", order, f"{out}/uc").awaitTermination()
        J.stream_daily(spark.readStream.schema(schema).parquet(src), "ts", "kind", "10 days", f"{out}/d", f"{out}/dc").awaitTermination()
        J.stream_trailing(spark.readStream.schema(schema).parquet(src), "ts", "kind", "10 days", f"{out}/t", f"{out}/tc", length="2 days").awaitTermination()
    assert rows(J.current(spark, f"{out}/u"), "id", "kind") == [(1, "b"), (2, "a"), (3, "a")]
    totals = J.running_totals(J.window_counts(spark, f"{out}/d")).select(F.to_date("start").cast("string"), "kind", "n", "total")
    assert rows(totals) == [("2024-01-01", "a", 3, 3), ("2024-01-02", "b", 1, 1)]
    trailing = J.window_counts(spark, f"{out}/t").select(F.to_date("start").cast("string"), "kind", "n")
    assert rows(trailing) == [("2023-12-31", "a", 3), ("2024-01-01", "a", 3), ("2024-01-01", "b", 1), ("2024-01-02", "b", 1)]


def test_discard(spark):
    from corpusgraph.functions.scale import cut

    table = cut(spark.range(3))
    path = table.inputFiles()[0]
    discard(table)
    import os

    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))


def test_rich_text_malformed_deep_and_text_ids(spark, rows):
    deep = {"type": "text", "text": "deep"}
    for _ in range(30):
        deep = {"type": "x", "children": [None, 5, deep]}
    deep = {"root": {"type": "root", "children": [{"type": "paragraph", "children": [deep, {"type": "link", "fields": {"url": "u"}, "children": [
        {"type": "text", "text": "a"}, {"type": "link", "fields": {"url": "v"}, "children": [{"type": "text", "text": "b"}]}, {"type": "text", "text": "c"}]}]}]}}
    posts = [("p", '{"root": '), ("q", json.dumps(deep)), ("r", "[1]"), ("s", ""), ("t", None), ("u", "nope"), ("v", json.dumps(TREE))]
    nodes = RT.rt_nodes(spark.createDataFrame(posts, "doc_id string, content string"))
    wrong = {r.doc_id: r.error for r in nodes.filter("error IS NOT NULL").collect()}
    assert set(wrong) == {"p", "u"}
    assert rows(RT.richtext_text(nodes), "doc_id", "text") == [
        ("p", ""), ("q", "deep a b c"), ("r", ""), ("s", ""), ("t", ""), ("u", ""), ("v", "Plan bold he re one in two boxed loose"),
    ]
    assert rows(RT.richtext_links(nodes).filter("doc_id = 'q'"), "url", "label") == [("u", "abc"), ("v", "b")] or rows(
        RT.richtext_links(nodes).filter("doc_id = 'q'"), "url", "label") == [("u", "ac"), ("v", "b")]
    # Both ways through a tree give the same rows.
    own = spark.createDataFrame([(1, json.dumps(TREE)), (2, json.dumps(deep)), (3, "{}"), (4, "[]")], "doc_id long, content string")
    assert rows(RT.rt_nodes(own)) == rows(RT._walked(own))
    assert "MapInPandas" not in RT.rt_nodes(own)._jdf.queryExecution().executedPlan().toString()
    variant = own.selectExpr("doc_id", "parse_json(content) AS content")
    assert rows(RT.rt_nodes(variant)) == rows(RT._walked(own))
