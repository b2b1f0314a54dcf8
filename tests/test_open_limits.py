"""Nothing is cut, capped or dropped unless a caller asks for it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgraph.functions.scale import top_k
from corpusgraph.operators import corpus, extract, search, vectors


def test_top_k_of_a_hot_group_beyond_the_window_limit(spark):
    rows = spark.range(3000).select(F.lit("hot").alias("g"), "id").union(spark.range(2).select(F.lit("cold").alias("g"), "id"))
    best = top_k(rows, ["g"], [F.desc("id")], 1001)
    assert {(r.g, r.n, r.low) for r in best.groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()} == {
        ("hot", 1001, 1999), ("cold", 2, 0)
    }
    assert best.filter("g = 'hot' AND rank = 1001").first().id == 1999


def test_events_keep_whole_sentences_and_late_years(spark):
    tail = "and so on " * 40
    text = f"On May 2, 2031 they met {tail}here. On May 2, 2031 they met {tail}there. Then 1/2/1999."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = extract.extract_events(docs).orderBy("ev_pos").collect()
    assert [(r.iso, r.description[-6:]) for r in found] == [("2031-05-02", " here."), ("2031-05-02", "there."), ("1999-01-02", "/1999.")]
    short = extract.extract_events(docs, max_year=2031, shortest=12, length=240, head=80).orderBy("iso").collect()
    assert [(r.iso, len(r.description) <= 240) for r in short] == [("1999-01-02", True), ("2031-05-02", True)]
    assert extract.extract_dates(docs, max_year=2026).first().dates == ["1999-01-02"]


def test_an_owner_keeps_all_events(spark):
    rows = [("own", 1, i, "1999-01-02", "d", "day", "x" * 90 + f" {i}", "Cases/own.md", "n") for i in range(90)]
    events = spark.createDataFrame(rows, "case string, doc_id long, ev_pos int, iso string, display string, precision string, description string, path string, source string")
    assert corpus.case_timeline(events).count() == 90
    assert corpus.case_timeline(events, 70).count() == 1
    none = events.limit(0)
    index = corpus.event_index(none, events, none)
    assert sorted(r["rank"] for r in index.collect()) == list(range(1, 91))
    assert corpus.event_index(none, events, none, 80).count() == 80


def _embedder():
    def embed(batch):
        if "bad" in batch:
            raise ValueError("cannot read this")
        return np.ones((len(batch), 2), np.float32)

    return embed


def test_failures_of_a_model_are_told(spark):
    texts = spark.createDataFrame([("a", 1, "good"), ("b", 1, "bad")], "id string, mtime long, text string").coalesce(1)
    made = {r.id: (r.vec, r.error) for r in vectors.embed(texts, _embedder(), "m").collect()}
    assert made["a"] == ([1.0, 1.0], None)
    assert made["b"][0] is None and "cannot read this" in made["b"][1]
    broken = vectors.embed(texts.withColumn("text", F.lit("bad")), _embedder(), "m")
    with pytest.raises(Exception, match="cannot read this"):
        broken.collect()


def test_search_by_meaning_only(spark):
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [0.0, 1.0])], "id string, vec array<float>")
    nodes = spark.createDataFrame([], "id string, label string, excerpt string, tags array<string>")
    found = search.hybrid_search(nodes, None, "~ b", 2, vecs=vecs, embedder=_embedder())
    assert [(r.source, r.id) for r in found.orderBy(F.desc("score"), "id").collect()] == [("semantic", "b"), ("semantic", "a")]
    with pytest.raises(ValueError):
        search.hybrid_search(nodes, None, "~ b")
