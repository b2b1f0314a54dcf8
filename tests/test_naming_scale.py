"""Entities and cases are found in the rows of their documents; results are checked against the joins and the SQL."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusgraph.functions import scale
from corpusgraph.functions.scale import contains_join
from corpusgraph.functions.text import BLANKS, UNEVEN, WS, squeeze
from corpusgraph.operators import corpus as C
from corpusgraph.operators import extract as X
from corpusgraph.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blanks_are_the_listed_ones(spark):
    letters = spark.range(0x10000).filter("id < 55296 OR id > 57343").select(F.col("id"), F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    found = {r.id for r in letters.filter(F.col("c").rlike(f"^{WS}$")).collect()}
    assert found == {i for i in range(0x10000) if re.match(f"[{BLANKS}]", chr(i))}
    assert {r.id for r in letters.filter(F.col("c").rlike(f"^(?:{UNEVEN})$")).collect()} == found - {32}
    odd = spark.createDataFrame([(" a  b\t c d \n",), ("a b",), ("　",)], "t string")
    assert [r.t for r in odd.select(squeeze(F.col("t")).alias("t")).collect()] == ["a b c d", "a b", ""]


def test_events_of_named_entities_as_by_the_joins(spark):
    texts = [
        (1, 'Ada  Quill spoke on May 1, 2019. "Bram Vale" left on 5/12/2019!  \'ADA QUILL SPOKE on May 1, 2019. Then  1 June 2020 came. In March 2018 ORB  closed.'),
        (2, "ada\tquill came in April 2020; Vale did not. Nothing here 2020. A Vale on May 40, 2019."), (3, None), (4, ""), (5, "ORB on May 1, 2019."), (1, "Quill again on May 1, 2019."),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bridge = spark.createDataFrame([(1, "Ada Quill"), (1, "Bram Vale"), (1, "Ada Quill"), (1, "ORB"), (1, None), (2, "Ada Quill"), (2, "Bram Vale"), (3, "ORB"), (9, "ORB")], "doc_id long, name string")
    keywords = C.entity_keywords(bridge.select("name").distinct(), spark.createDataFrame([], "name string, alias string"))
    columns = ["entity", "doc_id", "ev_pos", "iso", "display", "precision", "description"]
    want = sorted(tuple(r) for r in C.entity_events(X.extract_events(docs), bridge, keywords).select(columns).collect())
    named = bridge.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("name").alias("entity"), C.keywords_of(F.col("name")).alias("keywords"))).alias("entities"))
    files = docs.join(named, "doc_id", "left")
    got = C.entity_events_of(files)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == want
    assert {("Ada Quill", 1), ("Bram Vale", 1), ("ORB", 1), ("Ada Quill", 2)} <= {(r[0], r[1]) for r in want}
    # Beyond the test's own join, only the found events are moved.
    found = X.events_naming(files.select("doc_id", "text", F.flatten("entities.keywords").alias("w")), "w")
    assert _plan(found).count("Exchange") == _plan(files).count("Exchange")


def test_few_patterns_are_tried_as_they_are(spark, monkeypatch):
    left = spark.createDataFrame([(i, "a" if i % 2 else None, f"word{i} Überfluß x{i}y zz") for i in range(40)] + [(99, "a", None)], "id int, k string, t string")
    right = spark.createDataFrame([("a", p) for p in ("word1", "word1", "x3", "z", " ", "", "fluß x7y", None)] + [("b", "word2"), (None, "x")], "k string, p string")
    plain = contains_join(left, "t", right, "p", ["k"])
    assert "Generate" not in _plan(plain)
    few = sorted((r.id, r.p) for r in plain.collect())
    free = sorted((r.id, r.k or "", r.p) for r in contains_join(left, "t", right.select("p"), "p").collect())
    monkeypatch.setattr(scale, "_TRIED", 0)
    assert few == sorted((r.id, r.p) for r in contains_join(left, "t", right, "p", ["k"]).collect())
    assert free == sorted((r.id, r.k or "", r.p) for r in contains_join(left, "t", right.select("p"), "p").collect())


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """The smallest tables with missing, doubled and unnamed rows."""
    if not os.path.isdir(SF):
        pytest.skip("tables not present")
    folder, con = tmp_path_factory.mktemp("odd"), duckdb.connect()
    changed = {
        "supplier": f"SELECT * FROM '{SF}/supplier.parquet' WHERE s_suppkey <> 3 UNION ALL SELECT s_suppkey, 'Twin-of-' || s_name, s_nationkey, s_acctbal FROM '{SF}/supplier.parquet' WHERE s_suppkey = 5",
        "part": f"SELECT * REPLACE (CASE WHEN p_partkey % 9 = 1 THEN NULL ELSE p_brand END AS p_brand) FROM '{SF}/part.parquet' WHERE p_partkey % 7 <> 2 UNION ALL SELECT * FROM '{SF}/part.parquet' WHERE p_partkey % 5 = 0",
        "orders": f"SELECT * FROM '{SF}/orders.parquet' WHERE o_orderkey % 11 <> 4 UNION ALL SELECT * REPLACE (o_custkey + 1 AS o_custkey) FROM '{SF}/orders.parquet' WHERE o_orderkey % 13 = 0",
        "lineitem": f"SELECT * FROM '{SF}/lineitem.parquet' UNION ALL SELECT * FROM '{SF}/lineitem.parquet' WHERE l_orderkey % 3 = 0",
    }
    for name in "region nation customer supplier part orders lineitem".split():
        con.execute(f"COPY ({changed.get(name, f'SELECT * FROM {chr(39)}{SF}/{name}.parquet{chr(39)}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["entity_events", "case_membership", "entity_cases", "case_parties"])
def test_missing_and_doubled_rows_as_in_sql(spark, odd, name):
    folder, con = odd
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    expected = con.execute(ORACLES[name])
    at = [[d[0] for d in expected.description].index(c) for c in columns]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted((tuple(row[i] for i in at) for row in expected.fetchall()), key=repr)
