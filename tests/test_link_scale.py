"""Links and components move their rows no more than needed; results are checked against plain rules."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusgraph.operators import graph as G
from corpusgraph.plans import corpora as K

SF = "/root/testdata/sf0.001"


def test_links_read_the_order_lines_once(spark):
    assert K.links(spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1


def test_a_line_is_linked_to_what_there_is(spark, tmp_path):
    for name in ("region", "nation", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    one = orders.limit(1).withColumn("o_orderkey", F.lit(1).cast(orders.schema["o_orderkey"].dataType))
    one.unionByName(one).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    line = lines.limit(1).withColumns({"l_linenumber": F.lit(1), "l_partkey": F.lit(1)})
    keys = [(1, 1), (1, 9), (9, 1), (None, 1), (1, None)]
    rows = None
    for o, s in keys:
        own = line.withColumns({"l_orderkey": F.lit(o).cast("long"), "l_suppkey": F.lit(s).cast("long")})
        rows = own if rows is None else rows.unionByName(own)
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "S#1", 0)], "s_suppkey long, s_name string, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    found = Counter((r.source.removeprefix("shipments/shipment-"), r.target) for r in K.links(spark, str(tmp_path)).collect())
    o, s = "orders/order-1", "suppliers/s-1"
    assert found == {("1-1-1-1", o): 2, ("1-1-1-1", s): 1, ("1-1-1-9", o): 2, ("9-1-1-1", s): 1, ("1-1-1", s): 1, ("1-1-1", o): 2}


@pytest.mark.parametrize("clash", [False, True])
def test_components_of_strings_go_by_number(spark, monkeypatch, clash):
    if clash:
        monkeypatch.setattr(G, "_key", lambda col: F.lit(7).cast("long") + F.length(col))
    pairs = [("b", "a"), ("c", "b"), ("zz", "c"), ("x", "yy"), ("q", "q"), ("m", None)]
    links = spark.createDataFrame(pairs, "source string, target string")
    seen = []
    monkeypatch.setattr(G, "_stars", lambda l, run=G._stars: seen.append(l.schema["source"].dataType.simpleString()) or run(l))
    found = {r.id: r.component for r in G.component_labels(links).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "zz": "a", "x": "x", "yy": "x"}
    assert seen == ["string" if clash else "bigint"]
    nodes = spark.createDataFrame([(i, i * 2) for i in ("a", "b", "c", "zz", "x", "yy", "q")], "id string, folder string")
    rows = G.components(nodes, links, keep=["folder"]).collect()
    assert {(r.id, r.size, r.is_largest, r.folder) for r in rows} == {
        ("a", 4, True, "aa"), ("b", 4, True, "bb"), ("c", 4, True, "cc"), ("zz", 4, True, "zzzz"), ("x", 2, False, "xx"), ("yy", 2, False, "yyyy"), ("q", 1, False, "qq"),
    }


def test_best_neighbour_counts_the_links_it_joins(spark):
    links = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "h"), ("a", "b"), ("a", "b")], "source string, target string")
    found = G.best_neighbour(links)
    assert {(r.id, r.neighbour, r.degree) for r in found.collect()} == {("a", "b", 3), ("b", "a", 3), ("c", "h", 3), ("h", "a", 3)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2  # one exchange, used twice
