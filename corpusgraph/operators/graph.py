"""Link-graph analytics: degree, tiers, components, paths, navigation, subgraphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusgraph.functions.scale import cut, discard, ranked, with_neighbours


def adjacency(links: DataFrame) -> DataFrame:
    """id, neighbour: every link in both directions."""
    both = F.array(
        F.struct(F.col("source").alias("id"), F.col("target").alias("neighbour")),
        F.struct(F.col("target").alias("id"), F.col("source").alias("neighbour")),
    )
    return links.select(F.inline(both))


def degree(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id, degree; nodes without links count zero. One aggregation, no join."""
    ends = links.select(F.explode(F.array("source", "target")).alias("id"), F.lit(1).alias("one"))
    zero = nodes.select("id", F.lit(0).alias("one"))
    return zero.unionByName(ends).groupBy("id").agg(F.sum("one").alias("degree"))


def graph_stats(nodes: DataFrame, links: DataFrame, visible: DataFrame, indexed: DataFrame) -> DataFrame:
    """metric, n: nodes, links, visible, indexed."""
    parts = [("nodes", nodes), ("links", links), ("visible", visible), ("indexed", indexed)]
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("metric"), "n") for name, df in parts]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


def folder_centre(nodes: DataFrame, degrees: DataFrame) -> DataFrame:
    """folder, id, degree: highest degree per folder, smallest id on a tie."""
    best = F.min_by(F.struct("id", "degree"), F.struct(-F.col("degree"), "id"))
    return nodes.select("id", "folder").join(degrees, "id").groupBy("folder").agg(best.alias("b")).select("folder", "b.id", "b.degree")


def siblings(nodes: DataFrame) -> DataFrame:
    """id, folder, prev_id, next_id by label inside the folder, wrapping around."""
    rows = nodes.select("id", "folder", "label")
    out = with_neighbours(rows, ["folder"], [F.asc("label"), F.asc("id")], "id", "prev_id", "next_id")
    return out.drop("label")


def best_neighbour(links: DataFrame, degrees: DataFrame | None = None) -> DataFrame:
    """id, neighbour, degree: the linked node with the highest degree, as given or as the links have it.

    Without given degrees the links move once to be both counted and joined with their counts.
    """
    if degrees is None:
        ends = adjacency(links).repartition("neighbour")
        ranks = ends.groupBy("neighbour").agg(F.count("*").alias("degree"))
    else:
        ends, ranks = adjacency(links), degrees.select(F.col("id").alias("neighbour"), "degree")
    rows = ends.join(ranks, "neighbour")
    best = F.min_by(F.struct("neighbour", "degree"), F.struct(-F.col("degree"), "neighbour"))
    return rows.groupBy("id").agg(best.alias("b")).select("id", "b.neighbour", "b.degree")


def orphans(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id, folder of nodes without links: nodes and link ends meet in one aggregation."""
    ends = links.select(F.explode(F.array("source", "target")).alias("id"), F.lit(None).cast("string").alias("folder"), F.lit(1).alias("one"))
    rows = nodes.select("id", "folder", F.lit(0).alias("one")).unionByName(ends)
    counted = rows.groupBy("id").agg(F.max("folder").alias("folder"), F.sum("one").alias("degree"))
    return counted.filter("degree = 0").select("id", "folder")


def orphans_by_folder(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return orphans(nodes, links).groupBy("folder").agg(F.count("*").alias("n"))


def tiers(degrees: DataFrame, links: DataFrame, q: float = 0.85, ratio: float = 0.5) -> DataFrame:
    """id, degree, tier.

    Supernodes reach the degree at 0-based rank floor(q·n); ultranodes are
    supernodes with more than `ratio` supernodes among their neighbours. The
    rank is read off the degree histogram, which stays small because L links
    allow at most about 2·sqrt(L) distinct degrees.
    """
    histogram = degrees.groupBy("degree").agg(F.count("*").alias("n"))
    running = histogram.select("degree", F.sum("n").over(W.orderBy("degree")).alias("upto"))
    rank = degrees.agg(F.floor(F.count("*").cast("double") * F.lit(q))).scalar()
    threshold = running.filter(F.col("upto") > rank).agg(F.min("degree")).scalar()
    flagged = degrees.withColumn("_super", (F.col("degree") >= threshold) & (F.col("degree") > 0) & (threshold > 0))
    supers = flagged.filter("_super").select("id")
    pairs = adjacency(links).join(supers, "id", "left_semi")
    near = supers.select(F.col("id").alias("neighbour"), F.lit(1.0).alias("_hit"))
    share = pairs.join(near, "neighbour", "left").groupBy("id").agg(F.avg(F.coalesce("_hit", F.lit(0.0))).alias("_share"))
    out = flagged.join(share, "id", "left")
    tier = F.when(~F.col("_super"), "regular").when(F.col("_share") > ratio, "ultranode").otherwise("supernode")
    return out.select("id", "degree", tier.alias("tier"))


def component_labels(links: DataFrame) -> DataFrame:
    """id, component: smallest id of the connected component, for linked nodes.

    The rounds run on numbers: ids that are strings go by their hashes, unless two of them share one, and each
    component's smallest id is looked up at the end.
    """
    if not isinstance(links.schema["source"].dataType, StringType) or not isinstance(links.schema["target"].dataType, StringType):
        return _stars(links)
    links = cut(links.filter("source <> target").select("source", "target"))
    ends = links.select(F.explode(F.array("source", "target")).alias("id"))
    names = cut(ends.groupBy(_key("id").alias("key")).agg(F.min("id").alias("id"), F.max("id").alias("last")))
    if names.filter("id <> last").head(1):
        return _stars(links)
    stars = _stars(links.select(_key("source").alias("source"), _key("target").alias("target")))
    named = cut(names.select("key", "id").join(stars.select(F.col("id").alias("key"), F.col("component").alias("star")), "key").select("id", "star"))
    least = cut(named.groupBy("star").agg(F.min("id").alias("component")))
    return cut(named.join(least, "star").select("id", "component"))


def _key(col: str) -> Column:
    return F.xxhash64(col)


def _stars(links: DataFrame) -> DataFrame:
    """id, component by alternating large-star and small-star rounds (Kiveris et al., 2014).

    Each node's edges move to its smallest neighbour until every component is a
    star. Minima are pre-aggregated per node, so a hub costs one row per task.
    """
    edges = links.filter("source <> target")
    edges = cut(edges.select(F.greatest("source", "target").alias("u"), F.least("source", "target").alias("v")).distinct())
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v", F.lit(1).alias("down")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(0).alias("down")))))
        ends = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.sum("down").alias("down"), F.min("down").alias("least")))
        # Not stars yet, where a node has two edges to smaller ones, or lies between a larger and a smaller one.
        tangled = ends.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("least") == 0))).head(1)
        if not tangled:
            discard(ends)
            break
        low = ends.select("u", F.least("u", "m").alias("m"))
        # Larger neighbours of u move to u's minimum.
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Smaller neighbours of u, and u itself, move to u's minimum.
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        discard(edges)
        discard(ends)
        edges = after
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)


def components(nodes: DataFrame, links: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """id, component, size, is_largest, and the columns `keep` of the nodes; a node without links is its own component."""
    labels = component_labels(links)
    sizes = cut(labels.groupBy("component").agg(F.count("*").alias("size")))
    linked = nodes.select("id", *keep).join(labels, "id", "left").join(sizes, "component", "left")
    # Written, as the largest component is known only after all have been seen.
    out = cut(linked.select("id", F.coalesce("component", "id").alias("component"), F.coalesce("size", F.lit(1)).alias("size"), *keep))
    best = out.agg(F.min_by("component", F.struct(-F.col("size"), "component"))).scalar()
    return out.select("id", "component", "size", (F.col("component") == best).alias("is_largest"), *keep)


def component_sizes(labels: DataFrame) -> DataFrame:
    """component, size, rank over linked nodes, largest first."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    return ranked(sizes, [], [F.desc("size"), F.asc("component")])


def shortest_path(links: DataFrame, start: str, end: str, max_depth: int | None = None) -> DataFrame:
    """step, id along a shortest undirected path; empty when there is none.

    Level by level: a level's new nodes can only repeat the two levels before
    it, so nothing else is kept in the anti-joins. Each node keeps its
    smallest parent.
    """
    spark = links.sparkSession
    schema = "id string, parent string"
    level = spark.createDataFrame([(start, None)], schema)
    if start == end:
        return level.select(F.lit(0).cast("long").alias("step"), "id")
    links = cut(links.select("source", "target"))
    levels, previous = [level], None
    while max_depth is None or len(levels) <= max_depth:
        here = level.select(F.col("id").alias("parent"))
        out = links.select(F.col("source").alias("parent"), F.col("target").alias("id")).join(here, "parent")
        back = links.select(F.col("target").alias("parent"), F.col("source").alias("id")).join(here, "parent")
        reached = out.unionByName(back).groupBy("id").agg(F.min("parent").alias("parent"))
        reached = reached.join(level.select("id"), "id", "left_anti")
        if previous is not None:
            reached = reached.join(previous.select("id"), "id", "left_anti")
        previous, level = level, cut(reached)
        levels.append(level)
        state = level.agg(F.count("*"), F.count_if(F.col("id") == end)).first()
        if state[1]:
            break
        if not state[0]:
            return spark.createDataFrame([], "step long, id string")
    else:
        return spark.createDataFrame([], "step long, id string")
    # One row walks back through the levels.
    walk = levels[-1].filter(F.col("id") == end).select("parent", F.array("id").alias("path"))
    for table in reversed(levels[1:-1]):
        step = table.withColumnRenamed("parent", "_up")
        walk = walk.join(step, walk["parent"] == step["id"]).select(F.col("_up").alias("parent"), F.concat(F.array("id"), "path").alias("path"))
    walk = walk.select(F.concat(F.array("parent"), "path").alias("path"))
    return walk.select(F.posexplode("path").alias("step", "id")).withColumn("step", F.col("step").cast("long"))


# ── navigation and visibility ────────────────────────────────────────────────


def focus(links: DataFrame, node: str) -> DataFrame:
    """id: the node and its direct neighbours."""
    touching = links.filter((F.col("source") == node) | (F.col("target") == node))
    ids = touching.select(F.explode(F.array("source", "target")).alias("id"))
    alone = links.sparkSession.createDataFrame([(node,)], "id string")
    return ids.unionByName(alone).distinct()


def collapse(nodes: DataFrame, centres: DataFrame, folders: DataFrame) -> DataFrame:
    """id: all nodes, but only the centre of each collapsed folder (`folders(folder)`)."""
    shut = folders.select("folder", F.lit(True).alias("_shut")).distinct()
    # One row a closed folder, written: its size is known, so a folder of many nodes is no task's alone.
    closed = cut(shut.join(centres.select("folder", F.col("id").alias("_centre")), "folder", "left"))
    rows = nodes.select("id", "folder").join(closed, "folder", "left")
    return rows.filter(F.col("_shut").isNull() | (F.col("id") == F.col("_centre"))).select("id")


def visible_subgraph(nodes: DataFrame, links: DataFrame, *filters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes in every filter (`id`), and the links with both ends visible."""
    seen = nodes
    for ids in filters:
        seen = seen.join(ids.select("id").distinct(), "id", "left_semi")
    # Read once per end of a link: written first, so the filters run once.
    ids = cut(seen.select("id"))
    shown = links.join(ids.withColumnRenamed("id", "source"), "source", "left_semi")
    return seen, shown.join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def resolve_node(nodes: DataFrame, ref: str) -> DataFrame:
    """The node a reference means: its id, or the smallest id ending in it; `tag:x` gives the tagged nodes."""
    if ref.startswith("tag:"):
        return nodes.filter(F.array_contains("tags", ref[4:])).select("id")
    base = "-".join(ref.lower().split())
    named = (F.col("id") == ref) | (F.col("id") == base) | F.col("id").endswith("/" + base)
    return nodes.filter(named).select("id").orderBy("id").limit(1)


def favourites(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    return nodes.join(ids.select("id"), "id", "left_semi")
