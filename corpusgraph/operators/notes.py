"""Markdown notes to rows: nodes, tags, links, headings, call-outs, front matter, graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut, top_k
from corpusgraph.functions.text import WS, trim_blanks

_FENCED = r"^---\n[\s\S]*?\n---\n?"


def slugged(col: Column) -> Column:
    """Lower case, blanks to hyphens."""
    return F.lower(F.regexp_replace(col, f"{WS}+", "-"))


def note_id(path: Column) -> Column:
    return slugged(F.regexp_replace(path, r"\.md$", ""))


def top_folder(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.split_part(path, F.lit("/"), F.lit(1))).otherwise("")


def note_kind(path: Column) -> Column:
    folder = F.lower(F.split_part(path, F.lit("/"), F.lit(1)))
    return F.when(folder == "drops", "drop").when(folder == "memory", "memory").otherwise("note")


def note_keys(notes: DataFrame) -> DataFrame:
    """path, id, folder, type."""
    p = F.col("path")
    return notes.select("path", note_id(p).alias("id"), top_folder(p).alias("folder"), note_kind(p).alias("type"))


def file_name(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def note_title(body: Column, path: Column) -> Column:
    """First level-one heading, else the file name."""
    heading = trim_blanks(F.regexp_extract(body, rf"(?m)^#{WS}+(.+)$", 1))
    return F.coalesce(F.nullif(heading, F.lit("")), file_name(path))


def note_tags(body: Column) -> Column:
    """Front-matter tags, then every #token of the text, first-seen order."""
    front = F.regexp_extract(body, r"^---\n([\s\S]*?)\n---", 1)
    inline = F.regexp_extract(front, rf"tags:{WS}*\[([^\]]+)\]", 1)
    listed = F.when(
        inline != "", F.transform(F.split(inline, ","), lambda t: F.regexp_replace(trim_blanks(t), "['\"]", ""))
    ).otherwise(F.array().cast("array<string>"))
    bullets = F.regexp_extract(front, rf"tags:{WS}*\n((?:{WS}+-{WS}+.+\n?)+)", 1)
    items = F.transform(F.regexp_extract_all(bullets, F.lit(rf"-{WS}+(.+)"), F.lit(1)), lambda t: trim_blanks(t))
    tokens = F.regexp_extract_all(body, F.lit("#([a-zA-Z0-9_/-]+)"), F.lit(1))
    return F.array_distinct(F.concat(listed, items, tokens))


def wikilinks(body: Column) -> Column:
    """Targets of [[…]] links in order; links into a heading are not links to a note."""
    inner = F.regexp_extract_all(body, F.lit(r"\[\[([^\]|#]+?)(?:\|[^\]]+)?\]\]"), F.lit(1))
    return F.transform(inner, lambda t: slugged(trim_blanks(t)))


def note_excerpt(body: Column, length: int = 120) -> Column:
    text = F.regexp_replace(body, _FENCED, "")
    text = F.regexp_replace(text, rf"(?m)^#+{WS}+.+$", "")
    text = F.regexp_replace(text, r"\[\[([^\]]+)\]\]", "$1")
    text = trim_blanks(F.regexp_replace(F.regexp_replace(text, "[*_`]", ""), r"\n+", " "))
    return F.substring(text, 1, length)


def note_text(body: Column) -> Column:
    """Searchable text: no front matter, no markup, links reduced to their targets."""
    text = F.regexp_replace(body, _FENCED, "")
    text = F.regexp_replace(text, r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]", "$1")
    return trim_blanks(F.regexp_replace(F.regexp_replace(text, "[*_`#]", ""), r"\n+", " "))


def parse_notes(notes: DataFrame) -> DataFrame:
    """One node per note: id, label, path, type, tags, links, excerpt, created_at, modified_at, folder."""
    p, b = F.col("path"), F.col("body")
    created = F.col("created_at") if "created_at" in notes.columns else F.col("modified_at")
    return notes.select(
        note_id(p).alias("id"),
        note_title(b, p).alias("label"),
        "path",
        note_kind(p).alias("type"),
        note_tags(b).alias("tags"),
        wikilinks(b).alias("links"),
        note_excerpt(b).alias("excerpt"),
        created.alias("created_at"),
        "modified_at",
        top_folder(p).alias("folder"),
    )


def bodies(notes: DataFrame) -> DataFrame:
    """id, body."""
    return notes.select(note_id(F.col("path")).alias("id"), note_text(F.col("body")).alias("body"))


def _stripped(body: Column) -> Column:
    """Text below the front matter block, if the note has one."""
    end = F.locate("\n---", body, 4)
    below = trim_blanks(F.substring(body, end + 4, F.length(body)))
    return F.when(body.startswith("---") & (end > 0), below).otherwise(body)


def front_matter_map(notes: DataFrame) -> DataFrame:
    """path, props (key → value), tags, aliases, created, modified."""
    body = F.col("body")
    end = F.locate("\n---", body, 4)
    block = F.when(body.startswith("---") & (end > 0), trim_blanks(F.substring(body, F.lit(4), end - 4)))
    lines = notes.select("path", F.split(block, "\n").alias("lines")).filter("lines IS NOT NULL")

    def is_item(line: Column) -> Column:
        return line.rlike(rf"^{WS}+-{WS}")

    def key(line: Column) -> Column:
        return trim_blanks(F.substring_index(line, ":", 1))

    def value(line: Column) -> Column:
        return trim_blanks(F.substring(line, F.locate(":", line) + 1, F.length(line)))

    pairs = F.transform(
        F.filter("lines", lambda s: ~is_item(s) & F.contains(s, F.lit(":"))),
        lambda s: F.struct(key(s).alias("k"), value(s).alias("v")),
    )
    keyed = lines.withColumn("_pairs", pairs)
    # The last value of a repeated key counts.
    last = F.expr("filter(_pairs, (x, i) -> NOT exists(slice(_pairs, i + 2, size(_pairs)), y -> y.k = x.k))")
    keyed = keyed.withColumn("props", F.map_from_entries(last))

    def listed(name: str) -> Column:
        flat = F.try_element_at("props", F.lit(name))
        marks = F.transform("lines", lambda s: F.when(~is_item(s) & F.contains(s, F.lit(":")), key(s)))
        rest = F.slice("lines", F.array_position(marks, name).cast("int") + 1, F.size("lines"))
        stop = F.array_position(F.transform(rest, is_item), False).cast("int")
        items = F.when(stop > 0, F.slice(rest, F.lit(1), stop - 1)).otherwise(rest)
        items = F.transform(items, lambda s: trim_blanks(F.regexp_replace(s, rf"^{WS}+-{WS}+", "")))
        inner = F.split(F.substring(flat, F.lit(2), F.length(flat) - 2), ",")
        return (
            F.when(flat.isNull(), F.array().cast("array<string>"))
            .when(flat.startswith("["), F.filter(F.transform(inner, lambda t: trim_blanks(t)), lambda t: t != ""))
            .when(flat == "", items)
            .otherwise(F.array(flat))
        )

    def first_of(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at("props", F.lit(n)), F.lit("")) for n in names])

    return keyed.select(
        "path",
        "props",
        listed("tags").alias("tags"),
        listed("aliases").alias("aliases"),
        first_of("created", "date").alias("created"),
        first_of("modified", "updated").alias("modified"),
    )


def headings(notes: DataFrame) -> DataFrame:
    """path, pos, level, text, anchor of headings of level one to three."""
    lines = notes.select("path", F.posexplode(F.split(_stripped(F.col("body")), "\n")).alias("pos", "line"))
    found = lines.filter(F.col("line").rlike(rf"^#{{1,3}}{WS}+."))
    marks = F.regexp_extract("line", rf"^(#{{1,3}}){WS}+(.+)", 1)
    text = trim_blanks(F.regexp_replace(F.regexp_extract("line", rf"^(#{{1,3}}){WS}+(.+)", 2), r"[*_`\[\]]", ""))
    anchor = F.regexp_replace(F.lower("text"), r"[^\w\s-]", "")
    anchor = F.regexp_replace(F.regexp_replace(anchor, f"{WS}+", "-"), "-+", "-")
    rows = found.select("path", F.col("pos").cast("long").alias("pos"), F.length(marks).cast("long").alias("level"), text.alias("text"))
    return rows.withColumn("anchor", anchor)


_CALLOUT = r"^> \[!([A-Za-z]+)\](?: (.*))?$"


def callouts(notes: DataFrame) -> DataFrame:
    """path, pos, type, title, lines: `> [!type]` blocks up to the first line outside the quote.

    Runs of quoted lines are islands inside one note; the first header of a
    run opens the call-out and the rest of the run is its text.
    """
    lines = notes.select("path", F.posexplode(F.split(_stripped(F.col("body")), "\n")).alias("pos", "line"))
    quoted = lines.filter(F.col("line").startswith("> ") | (F.col("line") == ">"))
    in_note = W.partitionBy("path").orderBy("pos")
    runs = quoted.withColumn("run", F.col("pos") - F.row_number().over(in_note))
    opened = F.min(F.when(F.col("line").rlike(_CALLOUT), F.col("pos"))).over(
        W.partitionBy("path", "run").orderBy("pos")
    )
    inside = runs.withColumn("head", opened).filter("head IS NOT NULL")
    header = F.max(F.when(F.col("pos") == F.col("head"), F.col("line")))
    text = F.when(F.col("pos") > F.col("head"), F.struct("pos", F.regexp_replace("line", "^> ?", "").alias("t")))
    grouped = inside.groupBy("path", F.col("head").cast("long").alias("pos")).agg(
        header.alias("header"), F.array_sort(F.collect_list(text)).alias("body")
    )
    kind = F.regexp_extract("header", _CALLOUT, 1)
    title = trim_blanks(F.regexp_extract("header", _CALLOUT, 2))
    return grouped.select(
        "path",
        "pos",
        F.lower(kind).alias("type"),
        F.when(title != "", title).otherwise(F.upper(kind)).alias("title"),
        F.col("body.t").alias("lines"),
    )


def raw_links(nodes: DataFrame) -> DataFrame:
    """source, target_raw, pos."""
    return nodes.select(F.col("id").alias("source"), F.posexplode("links").alias("pos", "target_raw"))


def resolve_targets(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """source, target, pos: exact id, else the smallest id with the same base name.

    A target is looked up once, however many notes name it; the links then move once, to the answers.
    """
    base = F.element_at(F.split("id", "/"), -1)
    by_base = nodes.groupBy(base.alias("_base")).agg(F.min("id").alias("_by_base"))
    asked = links.select("target_raw").distinct().withColumn("_base", F.element_at(F.split("target_raw", "/"), -1))
    exact = nodes.select(F.col("id").alias("target_raw"), F.col("id").alias("_exact")).distinct()
    found = asked.join(by_base, "_base", "left").join(exact, "target_raw", "left")
    found = found.select("target_raw", F.coalesce("_exact", "_by_base").alias("target")).filter("target IS NOT NULL")
    # Written, so that Spark knows its size.
    rows = links.join(cut(found), "target_raw").filter("target <> source")
    return rows.groupBy("source", "target_raw", "target").agg(F.min("pos").alias("pos")).select("source", "target", "pos")


def build_links(nodes: DataFrame) -> DataFrame:
    """source, target: one link per unordered pair, first direction kept."""
    resolved = resolve_targets(raw_links(nodes), nodes)
    # The first of a pair's directions is the one from its smaller id, where a note has that link.
    back = F.min(F.col("source") > F.col("target")).alias("_back")
    pair = resolved.groupBy(F.least("source", "target").alias("_a"), F.greatest("source", "target").alias("_b")).agg(back)
    return pair.select(F.when(F.col("_back"), F.col("_b")).otherwise(F.col("_a")).alias("source"), F.when(F.col("_back"), F.col("_a")).otherwise(F.col("_b")).alias("target"))


def build_graph(notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes and links of a note collection; of two paths with one id the smaller stays.

    The nodes are written once: links, ids and base names all come from them.
    """
    nodes = cut(first_of_id(parse_notes(notes)))
    return nodes, build_links(nodes)


def first_of_id(nodes: DataFrame) -> DataFrame:
    """Of two paths with one id the smaller."""
    return top_k(nodes, ["id"], [F.col("path")], 1, "_rn").drop("_rn")


def backlinks(nodes: DataFrame, k: int = 20) -> DataFrame:
    """id, source, rank: notes whose links name the id or one of its `/` suffixes."""
    suffixes = F.expr("transform(sequence(1, size(split(id, '/'))), i -> concat_ws('/', slice(split(id, '/'), i, size(split(id, '/')))))")
    targets = nodes.select("id", F.explode(suffixes).alias("name"))
    naming = nodes.select(F.col("id").alias("source"), F.explode(F.array_distinct("links")).alias("name"))
    pairs = naming.join(targets, "name").select("id", "source").distinct()
    return top_k(pairs, ["id"], [F.col("source")], k)


def folder_counts(notes: DataFrame) -> DataFrame:
    """folder, n."""
    return notes.groupBy(top_folder(F.col("path")).alias("folder")).agg(F.count("*").alias("n"))


def apply_edits(notes: DataFrame, edits: DataFrame) -> DataFrame:
    """Notes with edited bodies; the latest edit of a path wins."""
    from corpusgraph.operators.corpus import upsert

    return upsert(notes, edits, "path", [F.desc("modified_at")])


def lookup(df: DataFrame, key: str, value: str, ignore_case: bool = False) -> DataFrame:
    """Rows whose `key` equals `value`; none is a legal answer."""
    if ignore_case:
        return df.filter(F.lower(key) == value.lower())
    return df.filter(F.col(key) == value)
