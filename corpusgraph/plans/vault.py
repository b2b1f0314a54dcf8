"""Queries over the linked note collection: parsing, graph, tags, time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.scale import checkpoint_root, cut
from corpusgraph.operators import graph as G
from corpusgraph.operators import notes as N
from corpusgraph.operators import tags as A
from corpusgraph.operators import timefilter as TF
from corpusgraph.plans import corpora as K
from corpusgraph.plans.registry import query
from corpusgraph.sources.notes import read_notes, write_notes

table = K.table

# ── parsing ──────────────────────────────────────────────────────────────────


@query("note_keys", "SELECT folder || '/' || label || '.md' AS path, id, folder, 'note' AS type FROM d_nodes")
def note_keys(spark: SparkSession, sf: str) -> DataFrame:
    return N.note_keys(K.vault(spark, sf))


@query("folder_counts", "SELECT folder, count(*) AS n FROM d_nodes GROUP BY 1")
def folder_counts(spark: SparkSession, sf: str) -> DataFrame:
    return N.folder_counts(K.vault(spark, sf))


@query(
    "note_titles",
    "SELECT id, label FROM d_docparsed UNION ALL SELECT id, label FROM d_nodes WHERE folder NOT IN (SELECT source FROM documents)",
)
def note_titles(spark: SparkSession, sf: str) -> DataFrame:
    return N.parse_notes(K.vault(spark, sf)).select("id", "label")


@query("note_tags", "SELECT id, tag FROM d_tags UNION SELECT id, unnest(tags) FROM d_docparsed")
def note_tags(spark: SparkSession, sf: str) -> DataFrame:
    return N.parse_notes(K.vault(spark, sf)).select("id", F.explode("tags").alias("tag"))


@query("wikilinks", "SELECT source, pos, target AS target_raw FROM d_wikilinks")
def wikilinks(spark: SparkSession, sf: str) -> DataFrame:
    return N.raw_links(N.parse_notes(K.vault(spark, sf)))


@query("excerpts", "SELECT id, excerpt, md5(body) AS digest FROM d_docparsed")
def excerpts(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("body")
    notes = K.document_notes(spark, sf)
    return notes.select(N.note_id(F.col("path")).alias("id"), N.note_excerpt(body).alias("excerpt"), F.md5(N.note_text(body)).alias("digest"))


@query(
    "front_matter",
    """SELECT folder || '/' || label || '.md' AS path, CASE folder WHEN 'Orders' THEN 3::BIGINT ELSE 1 END AS n,
          array_to_string(list_sort(tags), ',') AS tags, CASE folder WHEN 'Orders' THEN strftime(created_at, '%Y-%m-%d') END AS created
        FROM d_nodes WHERE folder NOT IN ('Regions', 'Nations', 'Shipments')""",
)
def front_matter(spark: SparkSession, sf: str) -> DataFrame:
    found = N.front_matter_map(K.vault(spark, sf))
    return found.select("path", F.size("props").cast("long").alias("n"), F.array_join(F.array_sort("tags"), ",").alias("tags"), "created")


@query(
    "headings",
    r"""SELECT folder || '/' || label || '.md' AS path, 0 AS pos, 1 AS level, replace(label, '_', '') AS text, lower(replace(replace(label, ' ', '-'), '_', '')) AS anchor
        FROM d_nodes WHERE folder NOT IN (SELECT source FROM documents)
        UNION ALL SELECT 'Orders/' || label || '.md', 5, 2, 'Buyer now', 'buyer-now' FROM d_nodes WHERE folder = 'Orders'
        UNION ALL SELECT path, pos, length(regexp_extract(line, '^(#{1,3})\s+(.+)', 1)), t,
          regexp_replace(regexp_replace(regexp_replace(lower(t), '[^\w\s-]', '', 'g'), '\s+', '-', 'g'), '-+', '-', 'g')
        FROM (SELECT path, pos, line, trim(regexp_replace(regexp_extract(line, '^(#{1,3})\s+(.+)', 2), '[*_`\[\]]', '', 'g')) AS t FROM (
          SELECT path, unnest(l) AS line, unnest(generate_series(0, len(l) - 1)) AS pos FROM (
            SELECT path, string_split(regexp_replace(regexp_replace(body, '^---\n[\s\S]*?\n---', ''), '^\s+|\s+$', '', 'g'), chr(10)) AS l FROM d_docnotes))
          WHERE regexp_matches(line, '^#{1,3}\s+.'))""",
)
def headings(spark: SparkSession, sf: str) -> DataFrame:
    return N.headings(K.vault(spark, sf))


@query(
    "callouts",
    """SELECT 'Orders/' || label || '.md' AS path, 2::BIGINT AS pos, 'note' AS type, 'Status' AS title, 'State ' || tags[2] AS lines
        FROM d_nodes WHERE folder = 'Orders'""",
)
def callouts(spark: SparkSession, sf: str) -> DataFrame:
    return N.callouts(K.vault(spark, sf)).withColumn("lines", F.array_join("lines", "|"))


@query(
    "apply_edits",
    """SELECT path, md5(coalesce(e.b, n.body)) AS digest FROM d_docnotes n LEFT JOIN (
          SELECT user_id, arg_max(event_type, (ts, event_type)) AS b FROM events GROUP BY 1) e ON e.user_id = n.doc_id""",
)
def apply_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Documents edited by the events of the user with the same number."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    path = F.concat("source", F.lit("/doc "), F.col("doc_id").cast("string"), F.lit(".md"))
    edits = table(spark, sf, "events").join(docs, F.col("user_id") == F.col("doc_id"))
    # Two edits at one instant are settled by their text.
    edits = edits.groupBy(path.alias("path"), F.col("ts").alias("modified_at")).agg(F.max("event_type").alias("body"))
    notes = K.document_notes(spark, sf).select("path", "modified_at", "body")
    return N.apply_edits(notes, edits).select("path", F.md5("body").alias("digest"))


@query("note_lookup", "SELECT id, label FROM d_nodes WHERE lower(label) = 'order 7'")
def note_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return N.lookup(K.nodes(spark, sf), "label", "ORDER 7", ignore_case=True).select("id", "label")


# ── links ────────────────────────────────────────────────────────────────────


@query("link_resolution", "SELECT source, target FROM d_links")
def link_resolution(spark: SparkSession, sf: str) -> DataFrame:
    nodes = cut(N.parse_notes(K.vault(spark, sf)).select("id", "links"))
    return N.resolve_targets(N.raw_links(nodes), nodes).select("source", "target")


@query("build_links", "SELECT source, target FROM d_links")
def build_links(spark: SparkSession, sf: str) -> DataFrame:
    # As `build_graph`, with only the columns that links come from.
    return N.build_links(cut(N.first_of_id(N.parse_notes(K.vault(spark, sf)).select("id", "path", "links")).drop("path")))


@query(
    "backlinks",
    """SELECT * FROM (SELECT id, source, row_number() OVER (PARTITION BY id ORDER BY source) AS rank FROM (
          SELECT target AS id, source FROM d_links UNION ALL SELECT id, id FROM d_nodes WHERE folder = 'Suppliers')) WHERE rank <= 20""",
)
def backlinks(spark: SparkSession, sf: str) -> DataFrame:
    return N.backlinks(cut(N.parse_notes(K.vault(spark, sf)).select("id", "links")))


@query("degree", "SELECT id, degree FROM d_degree")
def degree(spark: SparkSession, sf: str) -> DataFrame:
    return G.degree(K.nodes(spark, sf), K.links(spark, sf))


@query(
    "graph_stats",
    """SELECT 'nodes' AS metric, count(*) AS n FROM d_nodes UNION ALL SELECT 'links', count(*) FROM d_links
        UNION ALL SELECT 'visible', count(*) FROM d_nodes WHERE list_contains(tags, 'order') UNION ALL SELECT 'indexed', count(*) FROM documents""",
)
def graph_stats(spark: SparkSession, sf: str) -> DataFrame:
    nodes = K.nodes(spark, sf)
    return G.graph_stats(nodes, K.links(spark, sf), A.tag_isolation(nodes, ["order"], exact=True), table(spark, sf, "documents"))


_CENTRES = """SELECT folder, id, degree FROM (SELECT folder, id, degree, row_number() OVER (PARTITION BY folder ORDER BY degree DESC, id) AS k
        FROM d_nodes JOIN d_degree USING (id)) WHERE k = 1"""


@query("folder_centre", _CENTRES)
def folder_centre(spark: SparkSession, sf: str) -> DataFrame:
    nodes = cut(K.nodes(spark, sf).select("id", "folder"))
    return G.folder_centre(nodes, G.degree(nodes, K.links(spark, sf)))


@query(
    "siblings",
    """SELECT id, folder, coalesce(lag(id) OVER w, last_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_id,
          coalesce(lead(id) OVER w, first_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_id
        FROM d_nodes WINDOW w AS (PARTITION BY folder ORDER BY label, id)""",
)
def siblings(spark: SparkSession, sf: str) -> DataFrame:
    return G.siblings(K.nodes(spark, sf))


@query(
    "best_neighbour",
    """SELECT id, neighbour, degree FROM (SELECT a.id, a.neighbour, d.degree,
          row_number() OVER (PARTITION BY a.id ORDER BY d.degree DESC, a.neighbour) AS k FROM d_adj a JOIN d_degree d ON d.id = a.neighbour) WHERE k = 1""",
)
def best_neighbour(spark: SparkSession, sf: str) -> DataFrame:
    return G.best_neighbour(K.links(spark, sf))


@query(
    "orphans",
    """WITH n AS MATERIALIZED (SELECT id, folder FROM d_nodes), e AS MATERIALIZED (SELECT source AS id FROM d_links UNION SELECT target FROM d_links)
        SELECT id, folder FROM n ANTI JOIN e USING (id)""",
)
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    return G.orphans(K.nodes(spark, sf), K.links(spark, sf))


@query("orphans_by_folder", "SELECT folder, count(*) AS n FROM d_nodes JOIN d_degree USING (id) WHERE degree = 0 GROUP BY 1")
def orphans_by_folder(spark: SparkSession, sf: str) -> DataFrame:
    return G.orphans_by_folder(K.nodes(spark, sf), K.links(spark, sf))


@query(
    "tiers",
    """WITH t AS (SELECT degree AS t FROM (SELECT degree, row_number() OVER (ORDER BY degree) - 1 AS k FROM d_degree)
          WHERE k = (SELECT CAST(floor(count(*) * CAST(0.85 AS DOUBLE)) AS BIGINT) FROM d_degree)),
        s AS (SELECT id FROM d_degree, t WHERE degree >= t AND degree > 0 AND t > 0),
        n AS (SELECT a.id, avg(CASE WHEN x.id IS NULL THEN 0.0 ELSE 1.0 END) AS share FROM d_adj a SEMI JOIN s ON s.id = a.id
          LEFT JOIN s x ON x.id = a.neighbour GROUP BY a.id)
        SELECT d.id, d.degree, CASE WHEN s.id IS NULL THEN 'regular' WHEN n.share > 0.5 THEN 'ultranode' ELSE 'supernode' END AS tier
        FROM d_degree d LEFT JOIN s ON s.id = d.id LEFT JOIN n ON n.id = d.id""",
)
def tiers(spark: SparkSession, sf: str) -> DataFrame:
    links = cut(K.links(spark, sf))
    return G.tiers(cut(G.degree(K.nodes(spark, sf), links)), links)


_REACH = """WITH RECURSIVE v AS (SELECT source AS id FROM d_buyers UNION SELECT 'customer-' || c_custkey FROM customer),
        e AS (SELECT source AS x, target AS y FROM d_buyers UNION ALL SELECT target, source FROM d_buyers),
        r(id, c) AS (SELECT id, id FROM v UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.id),
        comp AS (SELECT id, min(c) AS component FROM r GROUP BY id),
        size AS (SELECT component, count(*) AS size FROM comp GROUP BY 1)"""


@query(
    "components",
    _REACH + """ SELECT id, component, size, component = (SELECT component FROM size ORDER BY size DESC, component LIMIT 1) AS is_largest
        FROM comp JOIN size USING (component)""",
)
def components(spark: SparkSession, sf: str) -> DataFrame:
    return G.components(*K.buyers(spark, sf))


@query(
    "component_sizes",
    _REACH + " SELECT component, size, row_number() OVER (ORDER BY size DESC, component) AS rank FROM size WHERE size > 1",
)
def component_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return G.component_sizes(G.component_labels(K.buyers(spark, sf)[1]))


@query(
    "vault_components",
    """SELECT CASE WHEN folder IN (SELECT source FROM documents) THEN 'alone' ELSE 'joined' END AS kind, count(*) AS n, count(DISTINCT folder) AS folders
        FROM d_nodes GROUP BY 1""",
)
def vault_components(spark: SparkSession, sf: str) -> DataFrame:
    """Everything traded hangs together; documents stand alone."""
    found = G.components(K.nodes(spark, sf), K.links(spark, sf), keep=["folder"])
    kind = F.when(F.col("is_largest"), "joined").when(F.col("size") == 1, "alone").otherwise("other")
    return found.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("folder").alias("folders"))


@query(
    "shortest_path",
    """WITH RECURSIVE b(id, d) AS (SELECT 'regions/asia', 0 UNION SELECT a.neighbour, b.d + 1 FROM b JOIN d_adj a ON a.id = b.id WHERE b.d < 8),
        dist AS (SELECT id, min(d) AS d FROM b GROUP BY id),
        walk(id, d) AS (SELECT id, d FROM dist WHERE id = 'regions/europe' UNION ALL
          SELECT (SELECT min(x.id) FROM dist x JOIN d_adj a ON a.neighbour = x.id WHERE a.id = walk.id AND x.d = walk.d - 1), walk.d - 1
          FROM walk WHERE walk.d > 0)
        SELECT CAST(d AS BIGINT) AS step, id FROM walk""",
)
def shortest_path(spark: SparkSession, sf: str) -> DataFrame:
    return G.shortest_path(K.links(spark, sf), "regions/asia", "regions/europe")


# ── visibility ───────────────────────────────────────────────────────────────


@query("focus", "SELECT DISTINCT unnest([source, target]) AS id FROM d_links WHERE 'nations/nation_3' IN (source, target)")
def focus(spark: SparkSession, sf: str) -> DataFrame:
    return G.focus(K.links(spark, sf), "nations/nation_3")


@query("collapse", f"SELECT id FROM d_nodes WHERE folder NOT IN ('Orders', 'Customers', 'src3') UNION SELECT id FROM ({_CENTRES}) WHERE folder IN ('Orders', 'Customers', 'src3')")
def collapse(spark: SparkSession, sf: str) -> DataFrame:
    nodes = cut(K.nodes(spark, sf).select("id", "folder"))
    centres = G.folder_centre(nodes, G.degree(nodes, K.links(spark, sf)))
    shut = spark.createDataFrame([("Orders",), ("Customers",), ("src3",)], "folder string")
    return G.collapse(nodes, centres, shut)


_SEEN = "SELECT id FROM d_nodes WHERE created_at BETWEEN TIMESTAMP '1997-12-31' AND TIMESTAMP '1998-12-31'"


def _visible(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # A filter over the union of note kinds would be worked out once per kind.
    nodes, links = cut(K.nodes(spark, sf).select("id", "created_at")), K.links(spark, sf)
    recent = TF.time_filter(nodes, "created_at", "1Y", "1998-12-31")
    return G.visible_subgraph(nodes, links, recent)


@query("visible_nodes", _SEEN)
def visible_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _visible(spark, sf)[0].select("id")


@query(
    "visible_links",
    f"""WITH seen AS MATERIALIZED ({_SEEN}), l AS MATERIALIZED (SELECT source, target FROM d_links)
        SELECT source, target FROM l JOIN seen a ON a.id = source JOIN seen b ON b.id = target""",
)
def visible_links(spark: SparkSession, sf: str) -> DataFrame:
    return _visible(spark, sf)[1].select("source", "target")


@query("resolve_node", "SELECT min(id) AS id FROM d_nodes WHERE id = 'order-12' OR id LIKE '%/order-12'")
def resolve_node(spark: SparkSession, sf: str) -> DataFrame:
    return G.resolve_node(K.nodes(spark, sf), "Order 12")


@query("tagged_nodes", "SELECT id FROM d_nodes WHERE list_contains(tags, 'NATION_3')")
def tagged_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return G.resolve_node(K.nodes(spark, sf), "tag:NATION_3")


@query("favourites", "SELECT id, label FROM d_nodes WHERE id IN (SELECT source || '/doc-' || doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1)")
def favourites(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "labels").filter("quality = 1").join(table(spark, sf, "documents"), "doc_id")
    ids = good.select(F.concat("source", F.lit("/doc-"), F.col("doc_id").cast("string")).alias("id"))
    return G.favourites(cut(K.nodes(spark, sf).select("id", "label")), ids).select("id", "label")


# ── tags ─────────────────────────────────────────────────────────────────────


@query("tag_counts", "SELECT tag, n FROM d_tag_counts")
def tag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.tag_counts(K.nodes(spark, sf))


@query("top_tags", "SELECT tag, n FROM d_top")
def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return A.top_tags(K.nodes(spark, sf))


@query("tag_pairs", "SELECT tag_a, tag_b, shared FROM d_shared")
def tag_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return A.tag_pairs(cut(K.nodes(spark, sf).select("id", "tags")))


@query("tag_isolation", "SELECT DISTINCT x.id FROM d_tags x JOIN d_tags y ON x.id = y.id WHERE contains(lower(x.tag), 'ord') AND contains(lower(y.tag), 'high')")
def tag_isolation(spark: SparkSession, sf: str) -> DataFrame:
    return A.tag_isolation(K.nodes(spark, sf), ["ORD", "high"]).select("id")


@query("tag_suggest", "SELECT tag FROM d_tag_counts WHERE contains(lower(tag), 'r') ORDER BY NOT starts_with(lower(tag), 'r'), tag LIMIT 8")
def tag_suggest(spark: SparkSession, sf: str) -> DataFrame:
    return A.tag_suggest(A.tag_counts(K.nodes(spark, sf)), "R")


# Nodes with at most two top tags, and those with three (an order's tags) by best overlap.
_ASSIGN = """SELECT n.id, CASE WHEN k = 0 THEN '' WHEN k = 1 THEN t[1] WHEN b.box IS NOT NULL THEN b.box
            WHEN k = 2 AND (SELECT n FROM d_top WHERE tag = t[1]) > (SELECT n FROM d_top WHERE tag = t[2]) THEN t[2] ELSE t[1] END AS box,
          CASE WHEN k < 2 OR b.box IS NOT NULL THEN k ELSE 1 END AS matched
        FROM (SELECT d.id, coalesce(t, []) AS t, coalesce(len(t), 0) AS k FROM d_nodes d LEFT JOIN (
            SELECT id, list(tag ORDER BY pos) AS t FROM (SELECT id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM d_nodes)
            WHERE tag IN (SELECT tag FROM d_top) GROUP BY id) u ON u.id = d.id) n
        LEFT JOIN (SELECT x.id, arg_min(tag_a || '∩' || tag_b, (-shared, tag_a || '∩' || tag_b)) AS box FROM d_tags x JOIN d_tags y ON x.id = y.id
          JOIN d_shared s ON s.tag_a = x.tag AND s.tag_b = y.tag
          WHERE x.tag IN (SELECT tag FROM d_top) AND y.tag IN (SELECT tag FROM d_top) GROUP BY x.id) b ON b.id = n.id"""


def _assigned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    nodes = cut(K.nodes(spark, sf).select("id", "tags"))
    top = cut(A.top_tags(nodes))
    return A.venn_assign(nodes, top, cut(A.tag_pairs(nodes, only=top))), top


@query("venn_assign", _ASSIGN)
def venn_assign(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf)[0]


# Tags in order of size; each step moves the first free nodes of a tag's overlaps.
_BACKFILL = f"""WITH RECURSIVE assigned AS ({_ASSIGN}),
        need AS (SELECT tag, row_number() OVER (ORDER BY n DESC, tag) AS pos, greatest(3 - coalesce(filled, 0), 0) AS need, coalesce(ids, []) AS ids
          FROM d_top LEFT JOIN (SELECT box, count(*) AS filled FROM assigned GROUP BY box) f ON f.box = tag
          LEFT JOIN (SELECT half, list(id ORDER BY id) AS ids FROM (SELECT id, unnest(string_split(box, '∩')) AS half FROM assigned
            WHERE contains(box, '∩') AND matched >= 2) GROUP BY half) c ON c.half = tag),
        step AS (SELECT CAST(0 AS BIGINT) AS pos, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS boxes
          UNION ALL SELECT pos, list_concat(old, pick), list_concat(boxes, list_transform(pick, lambda x: tag)) FROM (
            SELECT n.pos, n.tag, s.ids AS old, s.boxes, list_filter(n.ids, lambda x: NOT list_contains(s.ids, x))[1:n.need] AS pick
            FROM step s JOIN need n ON n.pos = s.pos + 1)),
        moved AS (SELECT unnest(ids) AS id, unnest(boxes) AS new_box FROM (SELECT * FROM step ORDER BY pos DESC LIMIT 1))
        SELECT a.id, coalesce(new_box, box) AS box, CASE WHEN new_box IS NOT NULL THEN 1 ELSE matched END AS matched
        FROM assigned a LEFT JOIN moved ON moved.id = a.id"""


@query("venn_backfill", _BACKFILL)
def venn_backfill(spark: SparkSession, sf: str) -> DataFrame:
    assigned, top = _assigned(spark, sf)
    return A.venn_backfill(cut(assigned), top)


# ── time ─────────────────────────────────────────────────────────────────────


@query("time_bounds", "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_ts FROM events")
def time_bounds(spark: SparkSession, sf: str) -> DataFrame:
    bounds = TF.time_bounds(table(spark, sf, "events"), "ts")
    return bounds.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("min_ts", "max_ts")])


@query(
    "time_presets",
    """SELECT preset, count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-31' - span AND TIMESTAMP '2024-01-31') AS n FROM events,
          (VALUES ('1D', INTERVAL 1 DAY), ('1W', INTERVAL 7 DAY), ('1M', INTERVAL 1 MONTH), ('1Y', INTERVAL 1 YEAR), ('ALL', INTERVAL 100 YEAR)) p(preset, span) GROUP BY 1""",
)
def time_presets(spark: SparkSession, sf: str) -> DataFrame:
    return TF.preset_counts(table(spark, sf, "events"), "ts", "2024-01-31")


@query(
    "timelapse_frames",
    """WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
        f AS (SELECT unnest(generate_series(0, CAST(ceil((hi - lo) / 172800000000.0) AS BIGINT))) AS frame, lo, hi FROM b),
        c AS (SELECT CAST(ceil((epoch_us(ts) - lo) / 172800000000.0) AS BIGINT) AS frame, count(*) AS n FROM events, b GROUP BY 1)
        SELECT f.frame, strftime(make_timestamp(least(lo + f.frame * 172800000000, hi)), '%Y-%m-%d %H:%M:%S') AS frame_end,
          coalesce(n, 0) AS n_new, CAST(sum(coalesce(n, 0)) OVER (ORDER BY f.frame) AS BIGINT) AS n_total FROM f LEFT JOIN c USING (frame)""",
)
def timelapse_frames(spark: SparkSession, sf: str) -> DataFrame:
    frames = TF.timelapse(table(spark, sf, "events"), "ts", days_per_frame=2)
    return frames.withColumn("frame_end", F.date_format("frame_end", "yyyy-MM-dd HH:mm:ss"))


# ── notes as files ───────────────────────────────────────────────────────────


@query(
    "notes_scan",
    """SELECT CASE doc_id % 10 WHEN 0 THEN '_drafts/' || source || '/doc ' || doc_id || '.md' WHEN 1 THEN source || '/_index ' || doc_id || '.md'
          ELSE path END AS path, length(coalesce(body, '')) AS chars, md5(coalesce(body, '')) AS digest FROM d_docnotes JOIN documents USING (doc_id)
        WHERE doc_id % 10 NOT IN (2, 3)""",
)
def notes_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as files, with drafts and index notes, hidden folders and other files between them, and read back."""
    key = F.regexp_extract("path", r"doc ([0-9]+)\.md$", 1).cast("long")
    notes = K.document_notes(spark, sf).select("path", F.coalesce("body", F.lit("")).alias("body"), (key % 10).alias("kind"))
    hidden = F.concat(F.lit(".trash/"), "path")
    placed = F.when(F.col("kind") == 0, F.concat(F.lit("_drafts/"), "path")).when(F.col("kind") == 1, F.regexp_replace("path", "/doc ", "/_index "))
    placed = placed.when(F.col("kind") == 2, hidden).when(F.col("kind") == 3, F.regexp_replace("path", r"\.md$", ".txt")).otherwise(F.col("path"))
    root = f"{checkpoint_root(spark)}/corpusgraph-{uuid.uuid4().hex}/notes"
    write_notes(notes.select(placed.alias("path"), "body"), root)
    return read_notes(spark, root).select("path", F.length("body").cast("long").alias("chars"), F.md5("body").alias("digest"))
