from pyspark.sql import functions as F

from corpusgraph.functions import scale
from corpusgraph.functions.scale import contains_join
from corpusgraph.operators import corpus as C
from corpusgraph.operators import extract as X
from corpusgraph.plans import articles as A


def test_events_with_the_cases_of_their_article_move_for_none(spark):
    members = spark.createDataFrame([("A", 1, "category"), ("B", 1, "entity"), ("C", 1, "entity")], '`case` string, doc_id long, strength string')
    docs = spark.createDataFrame([(1, "It was May 3, 2010, he said. Then 5/6/2011 in beta", "n", "2012-01-01")], "doc_id long, text string, note string, published_at string")
    words = spark.createDataFrame([("B", "beta"), ("C", "gamma")], '`case` string, keyword string')
    told = X.extract_events(docs.join(C.cases_of(members), "doc_id"), keep=["note", "published_at", "_strong", "_weak"])
    got = C.case_events(None, told, None, words)
    assert sorted((r["case"], r.ev_pos, r.iso) for r in got.collect()) == [("A", 0, "2010-05-03"), ("A", 1, "2011-05-06"), ("B", 1, "2011-05-06")]


def test_articles_of_cases_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(A, "cut", lambda df, *a: written.append(df.columns) or scale.cut(df, *a))
    tables = A.CaseTables(spark, "/root/testdata/sf0.001")
    assert "text" in tables.articles.columns
    assert not any("text" in columns for columns in written)


def test_a_wrong_date_lets_the_next_of_another_form_count(spark):
    texts = [
        "May 45, 2010 and June 2011", "May 1970 then June 5, 2011", "March 2015 or 1/2/2016", "13/13/2010 or July 2012", "June 5, 2011 and May 2010",
        "5/6/2013 and May 7, 2014", "May 1970, June 1971, 40/1/2000", "AUGUST  09 2020", "Mayor 2010", "October 1, 2010x", "May 12 34567",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.iso, r.display, r.precision) for r in X.extract_events(rows).collect()}
    assert got == {
        0: ("2011-06-01", "June 2011", "month"), 1: ("2011-06-05", "June 5, 2011", "day"), 2: ("2015-03-01", "March 2015", "month"),
        3: ("2012-07-01", "July 2012", "month"), 4: ("2011-06-05", "June 5, 2011", "day"), 5: ("2013-05-06", "May 6, 2013", "day"),
        7: ("2020-08-09", "August 9, 2020", "day"),
    }


def test_texts_meet_patterns_by_words_not_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(scale, "_TRIED", 0)
    asked = []
    pieces = scale._pieces
    monkeypatch.setattr(scale, "_pieces", lambda text, n: asked.append(str(text)) or pieces(text, n))
    texts = ["supplier17 and supplier117 went\tout", "supplier1", "ab cab", "x y", None, "", "out supplier17"]
    patterns = ["supplier17", "plier1", "ab", "17 and", "y", " ", " ", "out", "zz", ""]
    left = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    right = spark.createDataFrame([(p,) for p in patterns], "p string")
    want = sorted((i, p) for i, t in enumerate(texts) if t for p in patterns if p and p in t)
    for few in (200_000, 0):
        monkeypatch.setattr(scale, "_FEW", few)
        assert sorted((r.id, r.p) for r in contains_join(left, "t", right, "p").collect()) == want
    assert asked and not any("'t'" in a for a in asked)


def test_event_key_drops_what_is_no_letter_digit_or_space(spark):
    text = "It's A_B-cé 9\tİK\U0001f600  z"
    got = spark.createDataFrame([(text,)], "description string").select(C._event_key(None), F.regexp_replace(F.lower("description"), "[^a-z0-9 ]", "")).first()
    assert got[0] == got[1]


def test_written_events_serve_cases_too(spark, monkeypatch):
    """With all events written for the index, those of cases are not worked out again."""
    extracted = []
    monkeypatch.setattr(X, "extract_events", lambda docs, *a, **k: extracted.append(1) or docs.select("doc_id", F.lit(0).alias("ev_pos"), *[F.lit("2000-01-01").alias(c) for c in ("iso", "display", "precision", "description")], "note", "published_at"))
    tables = A.CaseTables(spark, "/root/testdata/sf0.001")
    assert tables.told is tables.told
    tables.events
    assert len(extracted) == 1
