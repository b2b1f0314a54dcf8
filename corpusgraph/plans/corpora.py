"""Document corpora and note collections derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.scale import once, spread
from corpusgraph.functions.text import safe_name


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"))


def shipments(spark: SparkSession, sf: str, dealt_by: str = "l_orderkey") -> DataFrame:
    """One row per order line: doc_id, the line's keys and its shipping day."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    # Dealt by order, they are in place for the join with orders too.
    lines = table(spark, sf, "lineitem").select(*keys, "l_shipdate").repartition(dealt_by).groupBy(*keys).agg(F.min("l_shipdate").alias("shipped"))
    return lines.withColumn("doc_id", F.concat_ws("-", *[F.col(k).cast("string") for k in keys]))


def _purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer and the customer's nation; joined before the lines come in, which are several an order."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    # Dealt by order, so that texts are made by all tasks, whichever side a join sends to the other.
    return rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).repartition("o_orderkey")


def _title(buyer: str | Column, nation: str | Column) -> Column:
    return F.concat(F.lit("Shipment "), "doc_id", F.lit(" for "), buyer, F.lit(" in "), nation)


def _categories() -> Column:
    return F.array("o_orderpriority", "c_mktsegment")


def _named_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments with the names `doc_entity` gives them as the list `entities`, and the names of their supplier."""
    sellers = table(spark, sf, "supplier").groupBy("s_suppkey").agg(F.collect_list(F.struct("s_name")).alias("_sellers"))
    brands = table(spark, sf, "part").groupBy("p_partkey").agg(F.collect_list(F.struct("p_brand")).alias("_brands"))
    # Dealt by part, the larger of the two tables; only keys and the day move on to the orders.
    rows = shipments(spark, sf, "l_partkey").join(brands, F.col("l_partkey") == F.col("p_partkey"), "left")
    rows = rows.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("p_partkey", "s_suppkey")
    every = F.flatten(F.transform("_sellers", lambda s: F.flatten(F.transform("_brands", lambda b: F.array(s["s_name"], b["p_brand"])))))
    none = F.array().cast("array<string>")
    return rows.withColumn("entities", F.coalesce(every, none)).withColumn("_sellers", F.coalesce("_sellers.s_name", none)).drop("_brands")


def case_files(spark: SparkSession, sf: str) -> DataFrame:
    """One row per shipment: doc_id, `entities`, and title and categories of its articles as the list `articles`.

    A shipment without an article has entities all the same.
    """
    bought = _purchases(spark, sf).select("o_orderkey", F.struct("c_name", "n_name", _categories().alias("categories")).alias("b"))
    bought = bought.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.collect_list("b").alias("_bought"))
    rows = _named_shipments(spark, sf).join(bought, "l_orderkey", "left")
    sold = F.flatten(F.array_repeat("_bought", F.size("_sellers")))
    told = F.transform(sold, lambda b: F.struct(_title(b["c_name"], b["n_name"]).alias("title"), b["categories"].alias("categories")))
    return rows.select("doc_id", "entities", told.alias("articles"))


def named_articles(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, text and `entities` of the articles: what `articles` tells and `doc_entity` names, in one row."""
    rows = _named_shipments(spark, sf).join(_purchases(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select("*", F.explode("_sellers").alias("s_name"))
    return rows.select("doc_id", _text().alias("text"), "entities")


def _text() -> Column:
    ordered = F.concat_ws("/", F.month("o_orderdate"), F.day("o_orderdate"), F.year("o_orderdate"))
    return F.concat(
        "s_name", F.lit(" shipped item "),
        F.col("l_partkey").cast("string"), F.lit(" on "), F.date_format("shipped", "MMMM d, yyyy"),
        F.lit(". The order was placed on "), ordered, F.lit(" by "), "c_name",
        F.lit(". Payment is due in "), F.date_format("shipped", "MMMM yyyy"), F.lit("."),
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """One article per shipment: priority and segment as categories, the customer as author."""
    rows = shipments(spark, sf).join(_purchases(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    title = _title("c_name", "n_name")
    return rows.select(
        "doc_id",
        F.concat(F.lit("ship-"), "doc_id").alias("slug"),
        title.alias("title"),
        safe_name(title).alias("note"),
        _text().alias("text"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00.000Z")).alias("published_at"),
        _categories().alias("categories"),
        F.array(F.col("n_nationkey").cast("long")).alias("category_ids"),
        F.array("c_name").alias("authors"),
    )


def doc_entity(spark: SparkSession, sf: str) -> DataFrame:
    """The supplier and the brand of each shipment."""
    rows = shipments(spark, sf).join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("doc_id", F.explode(F.array("s_name", "p_brand")).alias("name"))


def brand_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """Brands in each order."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("l_orderkey").alias("doc_id"), F.col("p_brand").alias("name")).distinct()


def case_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A case per region (titles name its nations, entities are its suppliers) and per market segment."""
    nation, region, supplier = (table(spark, sf, t) for t in ("nation", "region", "supplier"))
    placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    trade = F.concat("r_name", F.lit(" / Trade")).alias("case")
    titles = placed.select(trade, F.lit("title").alias("kind"), F.lower("n_name").alias("rule"))
    named = supplier.join(placed, F.col("s_nationkey") == F.col("n_nationkey"))
    entities = named.select(trade, F.lit("entity").alias("kind"), F.col("s_name").alias("rule"))
    segments = table(spark, sf, "customer").select("c_mktsegment").distinct()
    desks = segments.select(
        F.concat("c_mktsegment", F.lit(" Desk")).alias("case"), F.lit("category").alias("kind"), F.col("c_mktsegment").alias("rule")
    )
    return titles.unionByName(entities).unionByName(desks)


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Raw names with titles, possessives, middle names, bare surnames and offices."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    third = F.col("l_suppkey") % 3
    given = F.when(F.col("s_nationkey") % 3 == 0, "Ada").when(third == 0, "Bram").when(third == 1, "Cleo").otherwise("Dirk")
    family = F.concat(F.initcap(F.replace("r_name", F.lit(" "), F.lit(""))), F.char(F.col("n_nationkey") + 97))
    rows = once(rows, g=given, f=family)
    line = F.col("l_linenumber")
    name = (
        F.when(line == 1, F.concat_ws(" ", "g", "f"))
        .when(line == 2, F.concat_ws(" ", F.lit("Dr."), "g", "f"))
        .when(line == 3, F.concat_ws(" ", "g", F.lit("Mae"), "f"))
        .when(line == 4, F.col("f"))
        .when(line == 5, F.concat(F.when(F.col("g") == "Cleo", "Judge ").otherwise("President "), "g", F.lit(" "), "f", F.lit("'s")))
        .when(line == 6, F.concat("f", F.lit(" County")))
        .otherwise(F.concat("f", F.lit(" County District Attorney")))
    )
    rows = once(rows, name=name)
    return rows.select(F.col("l_orderkey").alias("doc_id"), "name", (F.col("l_orderkey") * 10 + line).alias("first_pos"))


def series_posts(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, pos, slug, title: part-numbered diaries of the goods on each order line."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = rows.groupBy("l_orderkey", "l_linenumber").agg(F.min("p_name").alias("p"))
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return lines.select(
        pos.alias("doc_id"), pos.alias("pos"), F.concat_ws("-", F.lit("ln"), key, line).alias("slug"),
        F.concat("p", F.lit(" freight diary Part "), line, F.lit(": order "), key).alias("title"),
    )


# ── the linked note collection ───────────────────────────────────────────────


def _plain(col: str) -> Column:
    return F.replace(col, F.lit("#"), F.lit(" "))


def _front(*lines: Column | str) -> Column:
    parts = [F.lit(p) if isinstance(p, str) else p for p in lines]
    return F.concat(F.lit("---\n"), *parts, F.lit("\n---\n"))


def vault(spark: SparkSession, sf: str) -> DataFrame:
    """path, body, created_at, modified_at: regions, nations, traders, orders and documents as notes."""
    t = {n: table(spark, sf, n) for n in ("region", "nation", "supplier", "customer", "orders")}
    nowhen = F.lit(None).cast("timestamp")

    def notes(df: DataFrame, folder: Column, name: Column, body: Column, created: Column) -> DataFrame:
        path = F.concat(folder, F.lit("/"), name, F.lit(".md"))
        return df.select(path.alias("path"), body.alias("body"), created.alias("created_at"), created.alias("modified_at"))

    regions = notes(t["region"], F.lit("Regions"), F.col("r_name"), F.concat(F.lit("# "), "r_name", F.lit("\n\n#region\n")), nowhen)
    n = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.concat(F.lit("# "), "n_name", F.lit("\n\nPart of [[Regions/"), "r_name", F.lit("|its region]]. #nation\n"))
    nations = notes(n, F.lit("Nations"), F.col("n_name"), body, nowhen)
    s = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    body = F.concat(
        _front("tags: [supplier, ", F.col("n_name"), "]"), F.lit("# "), _plain("s_name"),
        F.lit("\n\nBased in [["), "n_name", F.lit("]], see [["), _plain("s_name"), F.lit("]].\n"),
    )
    suppliers = notes(s, F.lit("Suppliers"), _plain("s_name"), body, nowhen)
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    body = F.concat(
        _front("tags:\n  - customer\n  - ", F.col("c_mktsegment")), F.lit("# "), _plain("c_name"),
        F.lit("\n\nLives in [[Nations/"), "n_name", F.lit("|"), "n_name", F.lit("]], asks the [[missing desk]].\n"),
    )
    customers = notes(c, F.lit("Customers"), _plain("c_name"), body, nowhen)
    o = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    name = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    body = F.concat(
        _front("title: ", name, "\ndate: ", F.date_format("o_orderdate", "yyyy-MM-dd"), "\ntags: [order, ", F.col("o_orderstatus"), ", ", F.col("o_orderpriority"), "]"),
        F.lit("# "), name, F.lit("\n\n> [!NOTE] Status\n> State "), "o_orderstatus", F.lit("\n\n## Buyer *now*\nPlaced by [["),
        _plain("c_name"), F.lit("]].\n"),
    )
    orders = notes(o, F.lit("Orders"), name, body, F.col("o_orderdate"))
    ship = shipments(spark, sf).join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    line = F.concat(F.lit("Shipment "), "doc_id")
    body = F.concat(
        F.lit("# "), line, F.lit("\n\nPart of [[Order "), F.col("l_orderkey").cast("string"),
        F.lit("]], sent by [["), _plain("s_name"), F.lit("|the supplier]].\n"),
    )
    sent = notes(ship, F.lit("Shipments"), line, body, F.col("shipped"))
    return regions.unionByName(sent).unionByName(nations).unionByName(suppliers).unionByName(customers).unionByName(orders).unionByName(
        document_notes(spark, sf)
    )


def document_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as notes; an event with the document's number gives the time."""
    events = table(spark, sf, "events").select("event_id", "ts")
    d = documents(spark, sf).join(events, F.col("doc_id") == F.col("event_id"), "left")
    key = F.col("doc_id").cast("string")
    body = F.concat(_front("tags: [", F.col("lang"), ", ", F.col("source"), "]"), "text")
    path = F.concat("source", F.lit("/doc "), key, F.lit(".md"))
    return d.select(path.alias("path"), body.alias("body"), F.col("ts").alias("created_at"), F.col("ts").alias("modified_at"))


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    """id, label, folder, tags, created_at of the note collection, straight from the tables."""
    t = {n: table(spark, sf, n) for n in ("region", "nation", "supplier", "customer", "orders", "documents", "events")}
    nowhen = F.lit(None).cast("timestamp")

    def rows(df: DataFrame, folder: Column, label: Column, tags: list, created: Column) -> DataFrame:
        key = F.lower(F.replace(F.concat(folder, F.lit("/"), label), F.lit(" "), F.lit("-")))
        return df.select(key.alias("id"), label.alias("label"), folder.alias("folder"), F.array(*tags).cast("array<string>").alias("tags"), created.alias("created_at"))

    s = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    d = t["documents"].join(t["events"], F.col("doc_id") == F.col("event_id"), "left")
    parts = [
        rows(t["region"], F.lit("Regions"), F.col("r_name"), [F.lit("region")], nowhen),
        rows(t["nation"], F.lit("Nations"), F.col("n_name"), [F.lit("nation")], nowhen),
        rows(s, F.lit("Suppliers"), _plain("s_name"), [F.lit("supplier"), F.col("n_name")], nowhen),
        rows(t["customer"], F.lit("Customers"), _plain("c_name"), [F.lit("customer"), F.col("c_mktsegment")], nowhen),
        rows(
            t["orders"], F.lit("Orders"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")),
            [F.lit("order"), F.col("o_orderstatus"), F.col("o_orderpriority")], F.col("o_orderdate"),
        ),
        rows(shipments(spark, sf), F.lit("Shipments"), F.concat(F.lit("Shipment "), "doc_id"), [], F.col("shipped")),
        rows(d, F.col("source"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")), [F.col("lang"), F.col("source")], F.col("ts")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def links(spark: SparkSession, sf: str) -> DataFrame:
    """source, target of the note collection, straight from the tables."""
    t = {n: table(spark, sf, n) for n in ("region", "nation", "supplier", "customer", "orders")}

    def key(folder: str, label: Column) -> Column:
        return F.lower(F.replace(F.concat(F.lit(folder + "/"), label), F.lit(" "), F.lit("-")))

    def rows(df: DataFrame, source: Column, target: Column) -> DataFrame:
        return df.select(source.alias("source"), target.alias("target"))

    region, nation = key("Regions", F.col("r_name")), key("Nations", F.col("n_name"))
    supplier, customer = key("Suppliers", _plain("s_name")), key("Customers", _plain("c_name"))
    order = key("Orders", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")))
    n = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    s = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    o = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    # A shipment's links to its order and its supplier are made in its row, so the order lines move once.
    known = t["orders"].groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.count("*").cast("int").alias("n"))
    senders = t["supplier"].groupBy(F.col("s_suppkey").alias("l_suppkey")).agg(F.collect_list(F.struct(supplier.alias("id"))).alias("senders"))
    sent = key("Shipments", F.concat(F.lit("Shipment "), "doc_id"))
    held = F.concat(F.lit("orders/order-"), F.col("l_orderkey").cast("string"))
    ends = F.concat(F.array_repeat(held, F.coalesce("n", F.lit(0))), F.coalesce("senders.id", F.array().cast("array<string>")))
    ship = shipments(spark, sf).join(known, "l_orderkey", "left").join(senders, "l_suppkey", "left")
    parts = [
        rows(s, supplier, nation),
        rows(c, customer, nation),
        rows(o, order, customer),
        ship.select(sent.alias("source"), F.explode(ends).alias("target")),
    ]
    out = rows(n, nation, region)
    for part in parts:
        out = out.unionByName(part)
    return out


def buyers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers and orders as nodes, each order linked to its customer: many components."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    order = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))
    ids = orders.select(order.alias("id")).unionByName(customer.select(_buyer(F.col("c_custkey")).alias("id")))
    return ids, orders.select(order.alias("source"), _buyer(F.col("o_custkey")).alias("target"))


def _buyer(key: Column) -> Column:
    return F.concat(F.lit("customer-"), key.cast("string"))
