"""The derived corpora of `corpora.py` as SQL views for the comparison engine."""

from __future__ import annotations

import re

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"

VIEWS = {
    "d_ship": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_shipdate) AS shipped,
          concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS doc_id
        FROM lineitem GROUP BY ALL""",
    "d_articles": """
        SELECT doc_id, 'ship-' || doc_id AS slug,
          'Shipment ' || doc_id || ' for ' || c_name || ' in ' || n_name AS title,
          'Shipment ' || doc_id || ' for ' || replace(c_name, '#', ' ') || ' in ' || n_name AS note,
          strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000Z' AS published_at,
          o_orderpriority AS priority, c_mktsegment AS segment, c_name AS author, n_nationkey AS nation,
          s_name, l_partkey, shipped, o_orderdate
        FROM d_ship JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey""",
    "d_doc_entity": """
        SELECT doc_id, unnest([s_name, p_brand]) AS name
        FROM d_ship JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "d_events": """
        SELECT doc_id, 0 AS ev_pos, strftime(shipped, '%Y-%m-%d') AS iso, strftime(shipped, '%B %-d, %Y') AS display,
          'day' AS precision, s_name || ' shipped item ' || l_partkey || ' on ' || strftime(shipped, '%B %-d, %Y') || '.' AS description
        FROM d_articles
        UNION ALL SELECT doc_id, 1, strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%B %-d, %Y'), 'day',
          'The order was placed on ' || strftime(o_orderdate, '%-m/%-d/%Y') || ' by ' || author || '.' FROM d_articles
        UNION ALL SELECT doc_id, 2, strftime(shipped, '%Y-%m') || '-01', strftime(shipped, '%B %Y'), 'month',
          'Payment is due in ' || strftime(shipped, '%B %Y') || '.' FROM d_articles""",
    "d_cases": """
        SELECT r_name || ' / Trade' AS name, 'title' AS kind, lower(n_name) AS rule
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT r_name || ' / Trade', 'entity', s_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT DISTINCT c_mktsegment || ' Desk', 'category', c_mktsegment FROM customer""",
    "d_membership": """
        SELECT name AS "case", doc_id, min(strength) AS strength FROM (
          SELECT c.name, a.doc_id, 'category' AS strength FROM d_articles a JOIN d_cases c
            ON (c.kind = 'title' AND contains(lower(a.title), c.rule))
            OR (c.kind = 'category' AND c.rule IN (a.priority, a.segment))
          UNION ALL SELECT c.name, e.doc_id, 'entity' FROM d_doc_entity e JOIN d_cases c
            ON c.kind = 'entity' AND c.rule = e.name)
        GROUP BY ALL""",
    "d_keywords": """
        SELECT DISTINCT name AS "case", k AS keyword FROM (
          SELECT name, lower(rule) AS k FROM d_cases
          UNION ALL SELECT name, unnest(string_split_regex(lower(name), '[\\s/]+')) FROM d_cases)
        WHERE length(k) >= 4""",
    "d_case_events": """
        SELECT DISTINCT m."case", e.doc_id, e.ev_pos, e.iso, e.display, e.precision, e.description, a.note
        FROM d_events e JOIN d_articles a USING (doc_id) JOIN d_membership m USING (doc_id)
        WHERE e.iso <= left(a.published_at, 10) AND (m.strength = 'category' OR EXISTS (
          SELECT 1 FROM d_keywords k WHERE k."case" = m."case" AND contains(lower(e.description), k.keyword)))""",
    "d_timeline": """
        SELECT * FROM d_case_events QUALIFY row_number() OVER (PARTITION BY "case", iso,
          regexp_replace(lower(description), '[^a-z0-9 ]', '', 'g') ORDER BY doc_id, ev_pos) = 1""",
    "d_entity_events": """
        SELECT name AS entity, e.* FROM d_events e JOIN d_doc_entity d USING (doc_id)
        WHERE contains(lower(description), lower(name))
        QUALIFY row_number() OVER (PARTITION BY name, iso,
          regexp_replace(lower(description), '[^a-z0-9 ]', '', 'g') ORDER BY doc_id, ev_pos) = 1""",
    "d_brands": """
        SELECT DISTINCT l_orderkey AS doc_id, p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "d_brand_pairs": """
        SELECT x.name AS a, y.name AS b, count(*) AS n FROM d_brands x JOIN d_brands y
          ON x.doc_id = y.doc_id AND x.name < y.name GROUP BY ALL""",
    # Raw mentions with titles, possessives, middle names, surnames and offices.
    "d_mentions": """
        SELECT l_orderkey AS doc_id, l_orderkey * 10 + l_linenumber AS first_pos,
          CASE l_linenumber
            WHEN 1 THEN given || ' ' || family WHEN 2 THEN 'Dr. ' || given || ' ' || family
            WHEN 3 THEN given || ' Mae ' || family WHEN 4 THEN family
            WHEN 5 THEN CASE WHEN given = 'Cleo' THEN 'Judge ' ELSE 'President ' END || given || ' ' || family || '''s'
            WHEN 6 THEN family || ' County' ELSE family || ' County District Attorney' END AS name
        FROM (SELECT l_orderkey, l_linenumber,
            CASE WHEN s_nationkey % 3 = 0 THEN 'Ada' WHEN l_suppkey % 3 = 0 THEN 'Bram'
              WHEN l_suppkey % 3 = 1 THEN 'Cleo' ELSE 'Dirk' END AS given,
            upper(left(r_name, 1)) || lower(substr(replace(r_name, ' ', ''), 2)) || chr(CAST(97 + n_nationkey AS INTEGER)) AS family
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey)""",
    "d_canon": """
        SELECT doc_id, name, bool_or(judge) AS judge, min(first_pos) AS first_pos FROM (
          SELECT doc_id, first_pos, regexp_matches(name, '(?i)^Judge\\b') AS judge,
            regexp_replace(regexp_replace(name, '''s$', ''), '^(Dr|Judge|President)\\.?\\s+', '') AS name FROM d_mentions)
        GROUP BY doc_id, name""",
    "d_grouped": """
        SELECT name, count(*) AS n_docs, bool_or(judge) AS judge, min(first_pos) AS first_pos FROM d_canon GROUP BY name""",
    "d_typed": """
        SELECT *, CASE WHEN judge THEN 'Judges'
          WHEN regexp_matches(name, '\\b(Court|Circuit|Tribunal|District)\\b') THEN 'Legal'
          WHEN regexp_matches(name, '\\b(County|City|Falls)\\b') THEN 'Places'
          ELSE 'People' END AS type FROM d_grouped""",
    "d_people": """
        SELECT name, n_docs, first_pos, lower(split_part(name, ' ', 1)) AS first,
          lower(string_split(name, ' ')[-1]) AS last
        FROM d_typed WHERE (type = 'People' OR judge) AND contains(name, ' ')""",
    "d_merged": """
        SELECT name, last, first_value(name) OVER (PARTITION BY first, last ORDER BY n_docs DESC, first_pos, name) AS target
        FROM d_people""",
    "d_single": """
        SELECT t.name, t.first_pos, count(DISTINCT m.target) AS n, min(m.target) AS target
        FROM d_typed t JOIN d_merged m ON lower(t.name) = m.last WHERE NOT contains(t.name, ' ') GROUP BY ALL""",
    "d_alias": """
        SELECT name, target FROM d_merged WHERE name <> target
        UNION SELECT name, target FROM d_single WHERE n = 1""",
    "d_resolved": """
        SELECT DISTINCT c.doc_id, coalesce(a.target, c.name) AS name FROM d_canon c LEFT JOIN d_alias a USING (name)""",
    "d_series": """
        SELECT l_orderkey * 10 + l_linenumber AS pos, 'ln-' || l_orderkey || '-' || l_linenumber AS slug,
          min(p_name) || ' freight diary Part ' || l_linenumber || ': order ' || l_orderkey AS title
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_linenumber""",
    # ── the linked note collection ──
    "d_nodes": """
        SELECT 'regions/' || lower(replace(r_name, ' ', '-')) AS id, r_name AS label, 'Regions' AS folder,
          ['region'] AS tags, NULL::TIMESTAMP AS created_at FROM region
        UNION ALL SELECT 'nations/' || lower(n_name), n_name, 'Nations', ['nation'], NULL FROM nation
        UNION ALL SELECT 'suppliers/' || lower(replace(s_name, '#', '-')), replace(s_name, '#', ' '), 'Suppliers',
          ['supplier', n_name], NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT 'customers/' || lower(replace(c_name, '#', '-')), replace(c_name, '#', ' '), 'Customers',
          ['customer', c_mktsegment], NULL FROM customer
        UNION ALL SELECT 'orders/order-' || o_orderkey, 'Order ' || o_orderkey, 'Orders',
          ['order', o_orderstatus, o_orderpriority], o_orderdate FROM orders
        UNION ALL SELECT 'shipments/shipment-' || doc_id, 'Shipment ' || doc_id, 'Shipments', [], shipped FROM d_ship
        UNION ALL SELECT source || '/doc-' || doc_id, 'doc ' || doc_id, source, [lang, source], ts
        FROM documents LEFT JOIN events ON event_id = doc_id""",
    "d_links": """
        SELECT 'nations/' || lower(n_name) AS source, 'regions/' || lower(replace(r_name, ' ', '-')) AS target
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'suppliers/' || lower(replace(s_name, '#', '-')), 'nations/' || lower(n_name)
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT 'customers/' || lower(replace(c_name, '#', '-')), 'nations/' || lower(n_name)
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT 'orders/order-' || o_orderkey, 'customers/' || lower(replace(c_name, '#', '-'))
        FROM orders JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT 'shipments/shipment-' || doc_id, 'orders/order-' || l_orderkey
        FROM d_ship JOIN orders ON o_orderkey = l_orderkey
        UNION ALL SELECT 'shipments/shipment-' || doc_id, 'suppliers/' || lower(replace(s_name, '#', '-'))
        FROM d_ship JOIN supplier ON l_suppkey = s_suppkey""",
    "d_degree": """
        SELECT id, count(e) AS degree FROM d_nodes LEFT JOIN
          (SELECT source AS e FROM d_links UNION ALL SELECT target FROM d_links) ON e = id GROUP BY id""",
    "d_adj": """
        SELECT source AS id, target AS neighbour FROM d_links UNION ALL SELECT target, source FROM d_links""",
    # Orders and their customers: many small components.
    "d_buyers": """
        SELECT 'order-' || o_orderkey AS source, 'customer-' || o_custkey AS target FROM orders""",
    "d_docnotes": """
        SELECT doc_id, source || '/doc ' || doc_id || '.md' AS path, source || '/doc-' || doc_id AS id,
          '---' || chr(10) || 'tags: [' || lang || ', ' || source || ']' || chr(10) || '---' || chr(10) || text AS body
        FROM documents""",
    "d_docparsed": r"""
        SELECT id, coalesce(nullif(trim(regexp_extract(body, '(?m)^#\s+(.+)$', 1)), ''), 'doc ' || doc_id) AS label,
          list_concat([lang, source], regexp_extract_all(body, '#([a-zA-Z0-9_/-]+)', 1)) AS tags,
          left(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(stripped, '(?m)^#+\s+.+$', '', 'g'),
            '\[\[([^\]]+)\]\]', '\1', 'g'), '[*_`]', '', 'g'), '\n+', ' ', 'g')), 120) AS excerpt,
          trim(regexp_replace(regexp_replace(regexp_replace(stripped,
            '\[\[([^\]|]+)(?:\|[^\]]+)?\]\]', '\1', 'g'), '[*_`#]', '', 'g'), '\n+', ' ', 'g')) AS body
        FROM (SELECT n.*, lang, source, regexp_replace(body, '^---\n[\s\S]*?\n---\n?', '') AS stripped
          FROM d_docnotes n JOIN documents USING (doc_id))""",
    "d_wikilinks": """
        SELECT source, 0 AS pos, target FROM d_links WHERE source LIKE 'nations/%'
        UNION ALL SELECT source, 0, split_part(target, '/', 2) FROM d_links WHERE source LIKE 'suppliers/%'
        UNION ALL SELECT source, 1, split_part(source, '/', 2) FROM d_links WHERE source LIKE 'suppliers/%'
        UNION ALL SELECT source, 0, target FROM d_links WHERE source LIKE 'customers/%'
        UNION ALL SELECT source, 1, 'missing-desk' FROM d_links WHERE source LIKE 'customers/%'
        UNION ALL SELECT source, 0, split_part(target, '/', 2) FROM d_links WHERE source LIKE 'orders/%'
        UNION ALL SELECT source, CASE WHEN target LIKE 'orders/%' THEN 0 ELSE 1 END, split_part(target, '/', 2)
        FROM d_links WHERE source LIKE 'shipments/%'""",
    "d_tags": "SELECT id, unnest(tags) AS tag FROM d_nodes",
    "d_tag_counts": "SELECT tag, count(*) AS n FROM d_tags GROUP BY tag",
    "d_top": "SELECT * FROM d_tag_counts WHERE n >= 5 ORDER BY n DESC, tag LIMIT 24",
    "d_shared": """
        SELECT x.tag AS tag_a, y.tag AS tag_b, count(*) AS shared FROM d_tags x JOIN d_tags y
          ON x.id = y.id AND x.tag < y.tag GROUP BY ALL HAVING count(*) >= 3""",
}


def _needed(text: str) -> list[str]:
    """Views used by `text`, each after the views it uses itself."""
    found: list[str] = []
    for name in re.findall(r"\bd_[a-z_]+\b", text):
        if name in VIEWS:
            for inner in [*_needed(VIEWS[name]), name]:
                if inner not in found:
                    found.append(inner)
    return found


def with_views(sql: str) -> str:
    """Prefix `sql` with the view definitions it needs."""
    parts = ", ".join(f"{name} AS ({VIEWS[name]})" for name in _needed(sql))
    if not parts:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {parts}, {body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[len('WITH '):]}"
    return f"WITH {parts} {body}"
