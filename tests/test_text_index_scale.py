"""Terms are counted inside their text; results are checked against plain rules."""

from pyspark.sql import functions as F

from corpusgraph.operators import search as S
from corpusgraph.plans import corpora as K
from corpusgraph.plans import finding

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_counted_inside_their_text(spark):
    texts = [["b", "a", "B", "", "\u00e9", "a"], ["x"], [], ["z"] * 9 + ["y"]]
    docs = spark.createDataFrame([(str(i), " ".join(t)) for i, t in enumerate(texts)] + [("n", None), ("1", "x w")], "id string, content string")
    held = docs.select("id", F.sort_array(F.split(F.coalesce("content", F.lit("q")), " ")).alias("t"))
    counted = held.select("id", F.inline(S._counted(F.col("t"))))
    assert "Aggregate" not in _plan(counted)
    index = S.build_index(docs, ("content",))
    found = {(r.id, r.term): (r.tf, r.length) for r in index.postings.collect()}
    assert found == {
        ("0", "a"): (2, 3), ("0", "b"): (2, 3), ("0", "\u00e9"): (1, 3), ("1", "x"): (2, 2), ("1", "w"): (1, 2), ("3", "y"): (1, 2), ("3", "z"): (9, 2),
    }
    assert {(r.term, r.df) for r in index.terms.collect()} == {(t, 1) for t in ("a", "b", "\u00e9", "x", "w", "y", "z")}
    assert [(r.n_docs, r.avg_length) for r in index.stats.collect()] == [(5, (3 + 1 + 0 + 2 + 2) / 5)]


def test_a_note_is_indexed_as_often_as_it_is_there(spark, monkeypatch):
    note = spark.createDataFrame([("s/doc 1.md", "one two one"), ("s/doc 1.md", "one two one")], "path string, body string")
    monkeypatch.setattr(K, "document_notes", lambda *_: note)
    found = finding._index(spark, SF).postings.filter("field = 'content'")
    assert {r.term: r.tf for r in found.collect()} == {"one": 4, "two": 2}
