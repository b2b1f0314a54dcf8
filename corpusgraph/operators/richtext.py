"""Rich-text trees to node, text, block and link tables.

A tree is parsed to a VARIANT and unfolded level by level inside its own row, a
few levels in one pass; only rows that go deeper enter another pass. Nodes then
become rows, numbered in document order. All of that is DataFrame work. JSON
that Spark's parser refuses, because it is malformed or nested deeper than it
allows, is walked in Python, where it still may turn out to be malformed: such
a document gives one row with the reason in `error`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions.scale import cut, once
from corpusgraph.functions.text import squeeze

_NODE = (
    "seq int, depth int, type string, text string, format int, url string, alt string,"
    " tag string, ordered boolean, item int, block int, link int, plain boolean, error string"
)
_COLUMNS = [part.split()[0] for part in _NODE.split(", ")]
# Block types that hold one run of inline text.
_TEXT_BLOCKS = {"heading", "paragraph", "quote", "listitem"}
#: Levels of a tree unfolded in one pass.
_LEVELS = 5
# Places of what stands beside the children, after all of them.
_ROOT, _NESTED = 2_000_000_000, 2_000_000_001

_FRONT = "struct<node:variant,kind:string,path:array<int>,mode:string,block:array<int>,link:array<int>,plain:boolean,ordered:boolean,item:int>"


def _get(node: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(node, path, kind)


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _front(node: Column, path: Column, mode: Column, block: Column, link: Column, plain: Column, ordered: Column, item: Column) -> Column:
    # The type is read once; an expression inside a lambda is worked out wherever it stands.
    values = (node, _get(node, "$.type", "string"), path, mode, block, link, plain, ordered, item)
    names = ("node", "kind", "path", "mode", "block", "link", "plain", "ordered", "item")
    return F.struct(*[c.alias(n) for n, c in zip(names, values, strict=True)])


def _no_path() -> Column:
    return F.lit(None).cast("array<int>")


def _facts(n: Column) -> dict[str, Column]:
    """What a node and the mode it is read in say of it and of what lies below."""
    kind, mode = F.coalesce(n["kind"], F.lit("")), n["mode"]
    block, inline, item = mode == "block", mode == "inline", mode == "item"
    holds_text = item | (block & kind.isin(*_TEXT_BLOCKS))
    leaf = block & kind.isin("horizontalrule", "upload")
    inner = F.when(inline | holds_text, "inline").when(leaf | (block & (kind == "block")), "hidden")
    return {
        "kind": F.when(item, "listitem").otherwise(n["kind"]),
        "block": F.when(holds_text | leaf, n["path"]).otherwise(n["block"]),
        "link": F.when(inline & kind.isin("link", "autolink"), n["path"]).otherwise(n["link"]),
        "inner": inner.when(block & (kind == "list"), "item").when(block, "block").otherwise("hidden"),
        "boxed": block & (kind == "block"),
    }


def _told(n: Column) -> Column:
    """The row of a node."""
    facts, node = _facts(n), n["node"]
    upload = F.coalesce(facts["kind"] == "upload", F.lit(False))
    given = F.coalesce(_filled(_get(node, "$.value.url", "string")), _get(node, "$.value.filename", "string"))
    named = F.coalesce(_filled(_get(node, "$.value.alt", "string")), _filled(_get(node, "$.value.title", "string")), F.lit("image"))
    return F.struct(
        n["path"].alias("path"), facts["kind"].alias("type"), _get(node, "$.text", "string").alias("text"),
        F.coalesce(_get(node, "$.format", "int"), F.lit(0)).alias("format"),
        F.coalesce(_filled(_get(node, "$.fields.url", "string")), F.when(upload, given)).alias("url"), F.when(upload, named).alias("alt"),
        _get(node, "$.tag", "string").alias("tag"), n["ordered"].alias("ordered"), n["item"].alias("item"), facts["block"].alias("block_path"),
        facts["link"].alias("link_path"), n["plain"].alias("plain"),
    )


def _below(n: Column) -> Column:
    """The nodes right below a node: its children, a root, and the tree inside a block of its own."""
    facts, node, no = _facts(n), n["node"], F.lit(None).cast("int")
    numbered = F.coalesce(_get(node, "$.listType", "string") == "number", F.lit(False))

    def child(c: Column, i: Column) -> Column:
        return _front(c, F.concat(n["path"], F.array(i)), facts["inner"], facts["block"], facts["link"], n["plain"], numbered, i + 1)

    def beside(path: str, place: int, mode: Column, plain: Column, wanted: Column) -> Column:
        inner = _get(node, path, "variant")
        here = _front(inner, F.concat(n["path"], F.array(F.lit(place))), mode, _no_path(), _no_path(), plain, F.lit(False), no)
        return F.when(wanted & inner.isNotNull(), F.array(here)).otherwise(F.array().cast(f"array<{_FRONT}>"))

    top = F.when((F.size(n["path"]) == 0) & ~facts["boxed"], "block").otherwise("hidden")
    every = F.concat(
        F.transform(F.coalesce(_get(node, "$.children", "array<variant>"), F.array().cast("array<variant>")), child),
        beside("$.root", _ROOT, top, n["plain"], F.lit(True)),
        beside("$.fields.content.root", _NESTED, F.lit("block"), F.lit(False), facts["boxed"]),
    )
    return F.filter(every, lambda x: _is_object(x["node"]))


def _is_object(node: Column) -> Column:
    return _get(node, "$", "map<string,variant>").isNotNull()


def _unfolded(trees: DataFrame) -> DataFrame:
    """_row, doc_id and a struct for every node of `trees(_row, doc_id, tree)`."""
    no = F.lit(None).cast("int")
    first = _front(F.col("tree"), F.array().cast("array<int>"), F.lit("block"), _no_path(), _no_path(), F.lit(True), F.lit(False), no)
    rows, found = trees.filter(_is_object(F.col("tree"))).select("_row", "doc_id", F.array(first).alias("front")), None
    told, below = F.transform("front", _told), F.flatten(F.transform("front", _below))
    while True:
        names = []
        for level in range(_LEVELS):
            # A generator of one row: what it makes is worked out once.
            made = F.inline(F.array(F.struct(told.alias(f"own{level}"), below.alias("front"))))
            rows = rows.select("_row", "doc_id", *names, made)
            names.append(f"own{level}")
        done = cut(rows.select("_row", "doc_id", F.concat(*names).alias("nodes"), "front"))
        own = done.select("_row", "doc_id", F.explode("nodes").alias("n"))
        found = own if found is None else found.unionByName(own)
        rows = done.filter(F.size("front") > 0).select("_row", "doc_id", "front")
        if not rows.head(1):
            return found


def _walk(content: str | None) -> Iterator[tuple]:
    """Nodes in document order, each with the block and link it belongs to."""
    tree = json.loads(content) if content else None
    seq = 0
    todo: list[tuple] = [(tree, 0, "block", None, None, True, False, None)]
    while todo:
        node, depth, mode, block, link, plain, ordered, item = todo.pop()
        if not isinstance(node, dict):
            if depth == 0:
                yield (0, 0, None, None, 0, None, None, None, False, None, None, None, False, None)
            continue
        kind = node.get("type")
        fields = node.get("fields") or {}
        value = node.get("value") or {}
        inner = "hidden"
        if mode == "inline":
            inner = "inline"
            if kind in ("link", "autolink"):
                link = seq
        elif mode == "item" or (mode == "block" and kind in _TEXT_BLOCKS):
            block, inner, kind = seq, "inline", "listitem" if mode == "item" else kind
        elif mode == "block" and kind in ("horizontalrule", "upload"):
            block = seq
        elif mode == "block":
            inner = "item" if kind == "list" else "block"
        url = fields.get("url") or (value.get("url") or value.get("filename") if kind == "upload" else None)
        alt = (value.get("alt") or value.get("title") or "image") if kind == "upload" else None
        yield (
            seq, depth, kind, node.get("text"), node.get("format") or 0, url, alt,
            node.get("tag"), ordered, item, block, link, plain, None,
        )
        seq += 1
        below = []
        for position, child in enumerate(node.get("children") or []):
            below.append((child, depth + 1, inner, block, link, plain, node.get("listType") == "number", position + 1))
        if "root" in node:
            below.append((node["root"], depth + 1, "block" if depth == 0 else "hidden", None, None, plain, False, None))
        if mode == "block" and kind == "block":
            nested = (fields.get("content") or {}).get("root")
            below = [(c, d, "hidden", b, lk, p, o, i) for c, d, _, b, lk, p, o, i in below]
            below.append((nested, depth + 1, "block", None, None, False, False, None))
        todo.extend(reversed(below))


def _walked(rows: DataFrame) -> DataFrame:
    """Nodes of `rows(doc_id, content)`, one row with the reason for a document that is not JSON."""
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(_NODE)])

    def flatten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text in zip(frame["doc_id"].tolist(), frame["content"].tolist(), strict=True):
                try:
                    out += [(doc, *n) for n in _walk(text)]
                except (ValueError, AttributeError, TypeError) as reason:
                    out.append((doc, 0, 0, None, None, 0, None, None, None, False, None, None, None, False, repr(reason)))
            made = pd.DataFrame(out, columns=schema.names)
            yield made.astype({"item": "Int64", "block": "Int64", "link": "Int64"})

    return rows.select("doc_id", "content").mapInPandas(flatten, schema)


def rt_nodes(posts: DataFrame) -> DataFrame:
    """Node rows of `posts(doc_id, content)`; content is JSON text or VARIANT.

    seq numbers a document's nodes in order from 0; block and link are the seq of the block and link a node lies in. A
    document without a tree has one row without a type, a malformed one such a row with an `error`.
    """
    parsed = posts.schema["content"].dataType.simpleString() == "variant"
    text = F.lit(None).cast("string") if parsed else _filled(F.col("content"))
    tree = F.col("content") if parsed else F.try_parse_json(text)
    rows = once(posts.select("doc_id", "content").withColumn("_row", F.monotonically_increasing_id()), tree=tree)
    refused = text.isNotNull() & F.col("tree").isNull()
    trees = cut(rows.select("_row", "doc_id", "tree", F.when(refused, text).alias("content")))
    nodes = _unfolded(trees.drop("content"))
    document = W.partitionBy("_row")
    numbered = nodes.select("_row", "doc_id", "n.*").withColumn("seq", F.row_number().over(document.orderBy("path")) - 1)

    def first(path: str) -> Column:
        # The block or link itself comes first of all that lie in it.
        return F.when(F.col(path).isNotNull(), F.min("seq").over(W.partitionBy("_row", path)))

    found = numbered.select(
        "doc_id", "seq", F.size("path").alias("depth"), "type", "text", "format", "url", "alt", "tag", "ordered", "item",
        first("block_path").alias("block"), first("link_path").alias("link"), "plain", F.lit(None).cast("string").alias("error"),
    )
    empty = trees.filter("content IS NULL").filter(~F.coalesce(_is_object(F.col("tree")), F.lit(False)))
    types = T._parse_datatype_string(_NODE)
    known = {"seq": F.lit(0), "depth": F.lit(0), "format": F.lit(0), "ordered": F.lit(False), "plain": F.lit(False)}
    blank = empty.select("doc_id", *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in types])
    out = found.select(*blank.columns).unionByName(blank)
    odd = trees.filter("content IS NOT NULL")
    return out.unionByName(_walked(odd)) if odd.head(1) else out


def _in_order(rows: Column, separator: str = "") -> Column:
    """Texts of one document's node rows joined in document order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["t"]), separator)


def _leaf() -> Column:
    inline = F.when(F.col("type") == "linebreak", "\n").otherwise(F.col("text"))
    return F.when(F.col("seq") != F.coalesce("block", F.lit(-1)), inline)


def richtext_text(nodes: DataFrame) -> DataFrame:
    """doc_id, text: plain text of every document, blanks squeezed."""
    leaf = F.when(F.col("plain") & (F.col("type") == "text") & (F.col("text") != ""), F.struct("seq", F.col("text").alias("t")))
    return nodes.groupBy("doc_id").agg(squeeze(_in_order(leaf, " ")).alias("text"))


def richtext_blocks(nodes: DataFrame) -> DataFrame:
    """doc_id, block, type, level, ordered, item, text, marks, url, alt: one row per block.

    `marks` unites the inline format bits (1 bold, 2 italic, 4 strike,
    8 underline, 16 code) found in the block.
    """
    own = F.col("seq") == F.col("block")
    leaf = F.when(_leaf().isNotNull(), F.struct("seq", _leaf().alias("t")))
    level = F.coalesce(F.nullif(F.regexp_extract("tag", "h([0-9]+)", 1), F.lit("")).cast("int"), F.lit(2))
    rows = nodes.filter("block IS NOT NULL").groupBy("doc_id", "block").agg(
        F.max(F.when(own, F.col("type"))).alias("type"),
        F.max(F.when(own & (F.col("type") == "heading"), F.least(level, F.lit(6)))).alias("level"),
        F.bool_or(F.when(own & (F.col("type") == "listitem"), F.col("ordered"))).alias("ordered"),
        F.max(F.when(own & (F.col("type") == "listitem"), F.col("item"))).alias("item"),
        F.btrim(_in_order(leaf), F.lit(" \t\n\x0b\x0c\r")).alias("text"),
        F.bit_or(F.when(F.col("type") == "text", F.col("format")).otherwise(0)).alias("marks"),
        F.max(F.when(own, F.col("url"))).alias("url"),
        F.max(F.when(own, F.col("alt"))).alias("alt"),
    )
    return rows


def richtext_links(nodes: DataFrame) -> DataFrame:
    """doc_id, link, url, label; a link without text is labelled by its URL."""
    leaf = F.when(_leaf().isNotNull() & (F.col("seq") != F.col("link")), F.struct("seq", _leaf().alias("t")))
    rows = nodes.filter("link IS NOT NULL").groupBy("doc_id", "link").agg(
        F.max(F.when(F.col("seq") == F.col("link"), F.col("url"))).alias("url"), _in_order(leaf).alias("_label")
    )
    url = F.coalesce("url", F.lit(""))
    return rows.select("doc_id", "link", url.alias("url"), F.coalesce(F.nullif("_label", F.lit("")), url).alias("label"))


def resolve_links(links: DataFrame, names: DataFrame) -> DataFrame:
    """Add `note`, the title of the linked article when the corpus has it; `links` carries `slug`."""
    return links.join(names.select("slug", "note"), "slug", "left").withColumn(
        "target", F.coalesce("note", "url")
    )
