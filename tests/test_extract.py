"""Names, dates and events in text."""

from pyspark.sql import functions as F

from corpusgraph.functions import defaults
from corpusgraph.functions import text as T
from corpusgraph.operators import extract as X


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_phrases(spark):
    texts = [
        "Ada Quill met Bram Vale.",
        "We read Judge Orla Finch's order at Bank of Tarn Valley",
        "they saw Iván Núñez Ortega there",
        "on Monday Night and January Rain",
        "it was Saint Monday then; War Room; The Quiet Man",
        "via One Two Three Four Five Six",
        "then Ada J.Quill Stone spoke",
    ]
    got = {}
    for r in X.phrase_candidates(_docs(spark, *texts), defaults.word_rules(spark)).collect():
        got.setdefault(r.doc_id, set()).add(r.name)
    assert got[0] == {"Ada Quill", "Bram Vale"}
    assert got[1] == {"Judge Orla Finch", "Bank of Tarn Valley"}
    assert 2 not in got  # accented words end an ASCII phrase: only one-word pieces are left
    assert 3 not in got
    assert 4 not in got
    assert got[5] == {"Five Six"}  # "One Two Three Four" starts with a stop word
    wide = X.phrase_candidates(_docs(spark, *texts), defaults.word_rules(spark), unicode=True)
    assert "Iván Núñez Ortega" in {r.name for r in wide.collect()}


def test_gazetteer(spark, rows):
    gaz = spark.createDataFrame(
        [("Tarn Valley", False), ("ORB", True), ("O'Dell & Co", False), ("Acme Inc.", False), ("quill", False)],
        "name string, case_sensitive boolean",
    )
    docs = _docs(spark, "in TARN valley now", "orb", "ORB!", "by o'dell & co, yes", "Acme Inc.com", "Acme Inc. left", "xquill", "quill", "", "Tarn  Valley", "Quill")
    assert rows(X.gazetteer_mentions(docs, gaz), "doc_id", "name") == [
        (0, "Tarn Valley"), (10, "quill"), (2, "ORB"), (3, "O'Dell & Co"), (4, "Acme Inc."), (7, "quill"),
    ]


def test_document_frequency(spark, rows):
    mentions = spark.createDataFrame(
        [(d, "Ada Quill") for d in range(4)] + [(d, "Bram Vale") for d in (0, 1, 2, 2)] + [(0, "ORB")], "doc_id long, name string"
    )
    gaz = spark.createDataFrame([("ORB",)], "name string")
    assert rows(X.entity_df(mentions, gaz, 4)) == [("Ada Quill", 4), ("ORB", 1)]


def test_dates(spark):
    docs = _docs(
        spark,
        "January 5, 2019 and january 5 2019, 5/12/2019, 31/12/2019, February 31, 2019; 1979 2027 March 1990",
        "xJanuary 5, 2019x 12/5/20199", "May 99, 2001", None,
    )
    got = {r.doc_id: (r.dates, r.years) for r in X.extract_dates(docs, max_year=2026).collect()}
    assert got[0] == (["2019-01-05", "2019-02-31", "2019-05-12"], [1990, 2019])
    assert got[1] == ([], [])
    assert got[2] == ([], [2001])
    assert 3 not in got


def test_events(spark):
    long_tail = "word " * 60
    docs = _docs(
        spark,
        "It began on March 3, 2001. Then on 4/5/2002 it moved in June 2002. Short 1/1/2001.",
        "Invalid May 45, 2001 then May 4, 2001 never counts but June 2001 does not come first.",
        f"On July 4, 1999 {long_tail}end.",
        "Same thing on May 1, 2010. Same thing on May 1, 2010. Quiet day.",
        "“Quoted on May 2, 2010 indeed.” ‘Next on May 3, 2010 indeed.’",
    )
    got = {}
    for r in X.extract_events(docs, max_year=2026, shortest=12, length=240, head=80).orderBy("doc_id", "iso", "ev_pos").collect():
        got.setdefault(r.doc_id, []).append((r.iso, r.display, r.precision, r.description))
    assert got[0] == [
        ("2001-01-01", "January 1, 2001", "day", "Short 1/1/2001."),
        ("2001-03-03", "March 3, 2001", "day", "It began on March 3, 2001."),
        ("2002-04-05", "April 5, 2002", "day", "Then on 4/5/2002 it moved in June 2002."),
    ]
    # Only the first match of a form is tried; the month form still applies.
    assert got[1] == [("2001-06-01", "June 2001", "month", "Invalid May 45, 2001 then May 4, 2001 never counts but June 2001 does not come first.")]
    assert len(got[2]) == 1 and got[2][0][3].endswith("…") and len(got[2][0][3]) <= 240
    assert len(got[3]) == 1
    assert [e[0] for e in got[4]] == ["2010-05-02", "2010-05-03"]
    assert got[4][0][3].startswith("Quoted")


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [(' A/B: "c" <d>  [x]. . ', None), ("", "2019-05-01"), ("x" * 200, "2021-01-01"), (None, "2019")], "t string, b string"
    )
    names = [r[0] for r in df.select(T.safe_name(F.col("t"))).collect()]
    assert names == ["A B c d x", "Untitled", "x" * 110, "Untitled"]
    spans = [r[0] for r in df.select(T.span(F.lit("2019-02-02"), F.col("b"))).collect()]
    assert spans == ["", "2019", "2019–2021", "2019"]
    urls = {
        "https://news.example/known-slug": "known-slug", "https://www.NEWS.example/a/": "a", "/rel": "rel", "rel2?x=1": "rel2",
        "https://news.example/a/b": None, "https://news.example/tag": None, "https://other.example/a": None, "mailto:x@y": None, "https://news.example/": None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.s for r in df.select("u", T.internal_slug(F.col("u"), ["news.example"]).alias("s")).collect()}
    assert got == urls
    df = spark.createDataFrame([("El HERNÁNDEZ dijo", "hernandez")], "a string, b string")
    assert df.select(T.contains_ai(F.col("a"), F.col("b"))).first()[0]
