"""Keyword and ranked full-text search."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut, once
from corpusgraph.functions.text import quoted
from corpusgraph.operators.tags import has_tag, has_tags
from corpusgraph.operators.vectors import Embedder, cosine_topk

# ── term scoring and the search box ──────────────────────────────────────────


def term_search(nodes: DataFrame, query: str, k: int = 20) -> DataFrame:
    """id, score: per term 10 for the label, 8 for a tag, 3 for the excerpt, 5 for the id."""
    score = F.lit(0)
    for term in query.lower().split():
        bare = term.removeprefix("#")
        score = (
            score
            + F.when(F.contains(F.lower("label"), F.lit(term)), 10).otherwise(0)
            + F.when(has_tag(F.col("tags"), bare), 8).otherwise(0)
            + F.when(F.contains(F.lower("excerpt"), F.lit(term)), 3).otherwise(0)
            + F.when(F.contains(F.col("id"), F.lit(term)), 5).otherwise(0)
        )
    scored = nodes.select("id", score.cast("long").alias("score")).filter("score > 0")
    return scored.orderBy(F.desc("score"), "id").limit(k)


def _box_filter(query: str) -> Column:
    terms = query.strip().lower().split()
    text = F.lower(F.concat_ws(" ", "label", "excerpt", F.col("id").cast("string")))
    ok = has_tags(F.col("tags"), [t[1:] for t in terms if t.startswith("#")])
    for term in terms:
        if not term.startswith("#"):
            ok = ok & F.contains(text, F.lit(term))
    return ok


def box_search(nodes: DataFrame, query: str, k: int = 20) -> DataFrame:
    """id of nodes with all #tags and all text terms."""
    return nodes.filter(_box_filter(query)).select("id").orderBy("id").limit(k)


def minus(hits: DataFrame, shown: DataFrame, k: int = 5) -> DataFrame:
    """Best `k` hits that are not already shown."""
    return hits.join(shown.select("id"), "id", "left_anti").orderBy(F.desc("score"), "id").limit(k)


def enrich(hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add label and excerpt; the id stands in for a missing label."""
    known = nodes.select("id", "label", "excerpt")
    return hits.join(known, "id", "left").withColumns(
        {"label": F.coalesce("label", F.col("id").cast("string")), "excerpt": F.coalesce("excerpt", F.lit(""))}
    )


# ── ranked full text ─────────────────────────────────────────────────────────

TOKEN = r"[^\n\r\p{Z}\p{P}]+"


def query_tokens(query: str) -> list[str]:
    """The query cut the way documents are: at line ends, separators and punctuation."""
    breaks = (c if c not in "\n\r" and unicodedata.category(c)[0] not in "ZP" else " " for c in query.lower())
    return "".join(breaks).split(" ") if query.strip() else []


@dataclass(frozen=True)
class TextIndex:
    """An inverted index; all its tables are sorted, so a search reads the parts and row groups that hold its words.

    postings(part, term, field, id, tf, length) lie in one folder per part, sorted by term and id; a common term may
    reach over several parts. terms(term, field, part, df) is sorted by term. pieces(piece, term) has every way to
    delete a few of a term's first letters, sorted by piece. stats(field, n_docs, avg_length) has one row per field.
    """

    postings: DataFrame
    terms: DataFrame
    pieces: DataFrame
    stats: DataFrame
    #: The largest share of its letters that a query term may be wrong in.
    fuzzy: float


#: First letters of a term that its pieces are made of. Where two terms are within a distance, deleting that many
#: letters at most from the first letters of each can make them equal, whatever follows.
PIECE_LETTERS = 8


def _reach(letters: int, fuzzy: float, most: int) -> int:
    """Mistakes allowed in a query term of this length."""
    return min(int(fuzzy * letters + 0.5), most)


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order))


def _pieces(terms: DataFrame, fuzzy: float, most: int) -> DataFrame:
    """piece, term: the first letters of each term with as many deleted as any query term near it may be wrong in."""
    n = F.length("term")
    # A query term that reaches `r` mistakes far has at most `r` letters more than the term.
    deepest = F.lit(0)
    for r in range(1, most + 1):
        shortest = next((k for k in range(1, 200) if _reach(k, fuzzy, most) >= r), None)
        if shortest is not None:
            deepest = F.when(n + r >= shortest, r).otherwise(deepest)
    letters = F.split(F.substring("term", 1, PIECE_LETTERS), "")
    rows = terms.select("term", letters.alias("_l"), F.least(deepest, F.least(n, F.lit(PIECE_LETTERS))).alias("_d"))
    size = F.size("_l")
    masks = F.filter(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), size) - 1), lambda m: F.bit_count(m) >= size - F.col("_d"))

    def kept(mask: Column) -> Column:
        return F.array_join(F.filter("_l", lambda _, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1), "")

    return rows.select(F.explode(F.array_distinct(F.transform(masks, kept))).alias("piece"), "term")


def _counted(tokens: Column) -> Column:
    """(term, tf) of each distinct token of a sorted array: a term reaches from where it starts to where the next one does."""
    starts = F.array_compact(F.transform(tokens, lambda t, i: F.when((i == 0) | (t != F.get(tokens, i - 1)), i)))

    def counts(found: Column) -> Column:
        return F.transform(
            found, lambda s, j: F.struct(F.get(tokens, s).alias("term"), (F.coalesce(F.get(found, j + 1), F.size(tokens)) - s).cast("long").alias("tf"))
        )

    # Bound by a lambda, the places are worked out once per text.
    return F.flatten(F.transform(F.array(starts), counts))


def build_index(docs: DataFrame, fields: tuple[str, ...] = ("title", "content"), fuzzy: float = 0.2, max_distance: int = 6) -> TextIndex:
    """Tables of an inverted index over `docs(id, <fields>)`, written once and read by every search.

    A text is cut once, and its terms are counted inside its row, so no task holds the terms of many texts; the counts
    are written, as dealing them out reads them twice. A field's length is its number of distinct terms. Postings are
    dealt out by ranges of (term, id), so a term that every document has is no task's alone.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    rows = docs.select("id", F.inline(pairs)).filter("text IS NOT NULL")
    tokens = F.sort_array(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)))
    counts = once(once(rows, tokens=tokens), terms=_counted(F.col("tokens")))
    held = cut(counts.select("id", "field", F.size("terms").cast("long").alias("length"), "terms"))
    lengths = cut(held.groupBy("field").agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_length")))
    counted = held.select("id", "field", "length", F.inline("terms"))
    if held.groupBy("id", "field").count().filter("count > 1").head(1):
        # Rows of one id are one document.
        counted = counted.groupBy("id", "field", "term").agg(F.max("length").alias("length"), F.sum("tf").alias("tf"))
    ranges = counted.select("term", "field", "id", "tf", "length").repartitionByRange("term", "id").withColumn("part", F.spark_partition_id())
    # Sorted by the folder first, as they are written: no second sort.
    postings = cut(ranges.sortWithinPartitions("part", "term", "field", "id"), "part")
    terms = _sorted(cut(postings.groupBy("term", "field", "part").agg(F.count("*").alias("df"))), "term")
    pieces = _sorted(cut(_pieces(terms.select("term").distinct(), fuzzy, max_distance)), "piece")
    return TextIndex(postings, terms, pieces, lengths, fuzzy)


def _query_pieces(term: str, reach: int) -> list[str]:
    head = term[:PIECE_LETTERS]
    kept = (k for n in range(max(len(head) - reach, 0), len(head) + 1) for k in combinations(head, n))
    return sorted({"".join(k) for k in kept})


def expand_terms(
    index: TextIndex, query: str, fuzzy: float = 0.2, prefix: bool = True,
    prefix_weight: float = 0.375, fuzzy_weight: float = 0.45, max_distance: int = 6,
) -> DataFrame:
    """source, term, weight: indexed terms a query term stands for.

    An exact term weighs 1; longer and misspelt forms weigh less the further
    they are. A term that is both counts as a prefix hit. Misspelt forms are
    looked up by their pieces, and only those found are measured.
    """
    if fuzzy > index.fuzzy:
        raise ValueError(f"the index finds misspelt terms up to fuzzy={index.fuzzy}")
    found = None
    for term in dict.fromkeys(t for t in query_tokens(query) if t):
        n = float(len(term))
        extra = F.length("term") - len(term)
        reach = _reach(len(term), fuzzy, max_distance)
        near = index.terms.filter(F.col("term").startswith(term) if prefix else F.col("term") == term).select("term")
        if reach:
            near = near.unionByName(index.pieces.filter(F.col("piece").isin(_query_pieces(term, reach))).select("term"))
        distance = F.levenshtein(F.col("term"), F.lit(term), reach) if reach else F.lit(-1)
        weight = (
            F.when(F.col("term") == term, 1.0)
            .when(F.lit(prefix) & F.col("term").startswith(term), prefix_weight * n / (n + 0.3 * extra))
            .when(distance > 0, fuzzy_weight * n / (n + distance))
        )
        own = near.distinct().select(F.lit(term).alias("source"), "term", weight.alias("weight")).filter("weight IS NOT NULL")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return index.terms.select(F.lit("").alias("source"), "term", F.lit(0.0).alias("weight")).limit(0)
    return found


def bm25(
    index: TextIndex, query: str, k: int | None = 10, fuzzy: float = 0.2, prefix: bool = True,
    boost: dict[str, float] | None = None, k1: float = 1.2, b: float = 0.7, delta: float = 0.5,
) -> DataFrame:
    """id, score: BM25+ over all fields, times the number of query terms found; the best `k`, or all.

    The terms asked for are written first, with the parts they lie in and their document frequencies, all from the
    index: their true size is known then, and where it is small Spark reads the postings of these parts only.
    """
    boost = {"title": 2.0} if boost is None else boost
    wanted = expand_terms(index, query, fuzzy, prefix)
    held = index.terms.join(wanted.select("term").distinct(), "term")
    freq = held.groupBy("term", "field").agg(F.sum("df").alias("df"))
    asked = cut(held.drop("df").join(freq, ["term", "field"]).join(wanted, "term"))
    # Weights are never 0; the filter tells Spark that this side is worth pruning parts by.
    rows = index.postings.join(asked.filter("weight > 0"), ["part", "term", "field"]).join(index.stats, "field")
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("avg_length"))
    field_boost = F.coalesce(*[F.when(F.col("field") == f, F.lit(float(w))) for f, w in boost.items()], F.lit(1.0))
    part = F.col("weight") * field_boost * idf * (delta + F.col("tf") * (k1 + 1) / norm)
    scored = rows.groupBy("id").agg(F.sum(part).alias("_s"), F.count_distinct("source").alias("_terms"))
    scored = scored.select("id", (F.col("_s") * F.col("_terms")).alias("score"))
    return scored if k is None else scored.orderBy(F.desc("score"), "id").limit(k)


def snippet(body: Column, query: str, before: int = 40, length: int = 120) -> Column:
    """Text around the earliest query word, words marked."""
    words = list(dict.fromkeys(query.lower().split()))
    low = F.lower(body)
    places = [F.nullif(F.locate(w, low), F.lit(0)) for w in words]
    first = F.least(*places) if len(places) > 1 else places[0] if places else F.lit(None).cast("int")
    start = F.greatest(F.coalesce(first - 1 - before, F.lit(0)), F.lit(0))
    size = F.length(body)
    end = F.least(size, start + length)
    piece = F.concat(
        F.when(start > 0, "…").otherwise(""),
        F.substring(body, start + 1, end - start),
        F.when(end < size, "…").otherwise(""),
    )
    return F.regexp_replace(piece, f"(?i)({quoted(words)})", "<mark>$1</mark>") if words else piece


def snippets(hits: DataFrame, texts: DataFrame, query: str) -> DataFrame:
    """id, snippet."""
    found = texts.join(hits.select("id"), "id", "left_semi")
    return found.select("id", snippet(F.col("body"), query).alias("snippet"))


def hybrid_search(
    nodes: DataFrame, index: TextIndex, query: str, k: int = 20, extra: int = 5,
    vecs: DataFrame | None = None, embedder: Embedder | None = None,
) -> DataFrame:
    """source, id, score: box hits first, then content hits not already among them.

    Queries of tags only search no content. A leading `~` asks for meaning
    only: the `k` vectors of `vecs(id, vec)` nearest to the query as `embedder` sees it.
    """
    if query.strip().startswith("~"):
        if vecs is None or embedder is None:
            raise ValueError("a ~ query needs vectors and the embedder they were made with")
        asked = [float(x) for x in embedder([query.strip().removeprefix("~").strip()])[0]]
        wanted = vecs.sparkSession.createDataFrame([(query, asked)], "query_id string, vec array<double>")
        return cosine_topk(vecs, wanted, k).select(F.lit("semantic").alias("source"), "id", "score")
    shown = box_search(nodes, query, k)
    title = shown.select(F.lit("title").alias("source"), "id", F.lit(None).cast("double").alias("score"))
    if all(t.startswith("#") for t in query.split()):
        return title
    content = minus(bm25(index, query, None), shown, extra)
    return title.unionByName(content.select(F.lit("content").alias("source"), "id", "score"))
