"""Queries over text search, vectors, rich text and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.functions.scale import checkpoint_root, cut
from corpusgraph.operators import notes as N
from corpusgraph.operators import richtext as RT
from corpusgraph.operators import search as S
from corpusgraph.operators import vectors as V
from corpusgraph.plans import corpora as K
from corpusgraph.plans.registry import query
from corpusgraph.streaming import jobs as J

table = K.table

# ── keyword search over the document notes ───────────────────────────────────


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return N.parse_notes(K.document_notes(spark, sf))


def _score(term: str) -> str:
    bare = term.removeprefix("#")
    return (
        f"CASE WHEN contains(lower(label), '{term}') THEN 10 ELSE 0 END"
        f" + CASE WHEN contains(lower(array_to_string(tags, chr(10))), '{bare}') THEN 8 ELSE 0 END"
        f" + CASE WHEN contains(lower(excerpt), '{term}') THEN 3 ELSE 0 END + CASE WHEN contains(id, '{term}') THEN 5 ELSE 0 END"
    )


@query(
    "term_search",
    f"""SELECT id, CAST(score AS BIGINT) AS score FROM (SELECT id, {_score('doc')} + {_score('#en')} + {_score('the')} + {_score('src1')} AS score FROM d_docparsed)
        WHERE score > 0 ORDER BY score DESC, id LIMIT 20""",
)
def term_search(spark: SparkSession, sf: str) -> DataFrame:
    return S.term_search(_nodes(spark, sf), "Doc #en the src1")


_BOX = """SELECT id FROM d_docparsed WHERE contains(lower(array_to_string(tags, chr(10))), 'en')
        AND contains(lower(label || ' ' || excerpt || ' ' || id), 'tion') AND contains(lower(label || ' ' || excerpt || ' ' || id), 'the') ORDER BY id LIMIT 20"""


@query("box_search", _BOX)
def box_search(spark: SparkSession, sf: str) -> DataFrame:
    return S.box_search(_nodes(spark, sf), "#en tion the")


_WORDS = r"regexp_extract_all(lower({0}), '[^\n\r\pZ\pP]+')"


def _bm25_sql(query_text: str, fuzzy: float, prefix: bool, k: int | None) -> str:
    """The ranking formula over the document notes, as SQL."""
    weights = []
    for term in dict.fromkeys(query_text.lower().split()):
        n, reach = float(len(term)), int(fuzzy * len(term) + 0.5)
        longer = f"WHEN {str(prefix).upper()} AND starts_with(term, '{term}') THEN 0.375 * {n} / ({n} + 0.3 * (length(term) - {len(term)}))"
        # The engine counts bytes: any other letter stands in for a longer one.
        away = rf"levenshtein(regexp_replace(term, '[^\x00-\x7F]', '~', 'g'), '{term}')"
        near = f"WHEN {away} <= {reach} THEN 0.45 * {n} / ({n} + {away})"
        weights.append(f"SELECT '{term}' AS source, term, CASE WHEN term = '{term}' THEN 1.0 {longer} {near} END AS weight FROM vocab")
    return rf"""
        f AS (SELECT id, 'title' AS field, {_WORDS.format('label')} AS w FROM d_docparsed
          UNION ALL SELECT id, 'content', {_WORDS.format('body')} FROM d_docparsed),
        p AS (SELECT id, field, term, count(*) AS tf FROM (SELECT id, field, unnest(w) AS term FROM f) GROUP BY ALL),
        l AS (SELECT id, field, len(list_distinct(w)) AS len FROM f), st AS (SELECT field, count(*) AS n, avg(len) AS av FROM l GROUP BY 1),
        vocab AS (SELECT DISTINCT term FROM p),
        x AS (SELECT source, term, CAST(weight AS DOUBLE) AS weight FROM ({' UNION ALL '.join(weights)}) WHERE weight IS NOT NULL),
        df AS (SELECT term, field, count(*) AS df FROM p WHERE term IN (SELECT term FROM x) GROUP BY ALL),
        r AS (SELECT id, source, weight * CASE WHEN field = 'title' THEN 2.0 ELSE 1.0 END * ln(1 + (n - df + 0.5) / (df + 0.5))
            * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * len / av))) AS s
          FROM p JOIN x USING (term) JOIN df USING (term, field) JOIN st USING (field) JOIN l USING (id, field)),
        hits AS (SELECT id, sum(s) * count(DISTINCT source) AS score FROM r GROUP BY id ORDER BY score DESC, id{f' LIMIT {k}' if k else ''})"""


def _index(spark: SparkSession, sf: str) -> S.TextIndex:
    path, body = F.col("path"), F.col("body")
    fields = [N.note_title(body, path).alias("title"), N.note_text(body).alias("content")]
    return S.build_index(K.document_notes(spark, sf).select(N.note_id(path).alias("id"), *fields))


@query("bm25", f"WITH {_bm25_sql('anon thestha', 0, False, 10)} SELECT id, round(score, 6) AS score FROM hits")
def bm25(spark: SparkSession, sf: str) -> DataFrame:
    hits = S.bm25(_index(spark, sf), "anon thestha", 10, fuzzy=0, prefix=False)
    return hits.withColumn("score", F.round("score", 6))


@query("bm25_fuzzy", f"WITH {_bm25_sql('stion enand', 0.2, True, 20)} SELECT id, round(score, 6) AS score FROM hits")
def bm25_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    return S.bm25(_index(spark, sf), "stion enand", 20).withColumn("score", F.round("score", 6))


@query(
    "text_index",
    rf"""SELECT field, count(*) AS postings, CAST(sum(tf) AS BIGINT) AS tokens, count(DISTINCT term) AS terms FROM (
          SELECT id, field, term, count(*) AS tf FROM (
            SELECT id, 'title' AS field, unnest({_WORDS.format('label')}) AS term FROM d_docparsed
            UNION ALL SELECT id, 'content', unnest({_WORDS.format('body')}) FROM d_docparsed) GROUP BY ALL) GROUP BY field""",
)
def text_index(spark: SparkSession, sf: str) -> DataFrame:
    postings = _index(spark, sf).postings
    return postings.groupBy("field").agg(
        F.count("*").alias("postings"), F.sum("tf").alias("tokens"), F.count_distinct("term").alias("terms")
    )


_SNIPPET = """SELECT id, regexp_replace(CASE WHEN s > 0 THEN '…' ELSE '' END || substr(body, s + 1, least(length(body), s + 120) - s)
          || CASE WHEN least(length(body), s + 120) < length(body) THEN '…' ELSE '' END, '(?i)(stion|anon)', '<mark>\\1</mark>', 'g') AS snippet
        FROM (SELECT id, body, greatest(coalesce(least(nullif(position('stion' IN lower(body)), 0), nullif(position('anon' IN lower(body)), 0)) - 41, 0), 0) AS s
          FROM d_docparsed)"""


@query("snippets", _SNIPPET)
def snippets(spark: SparkSession, sf: str) -> DataFrame:
    texts = N.bodies(K.document_notes(spark, sf))
    return texts.select("id", S.snippet(F.col("body"), "stion anon").alias("snippet"))


@query(
    "hybrid_search",
    f"""WITH {_bm25_sql('tion the', 0.2, True, None)}, box AS (SELECT id FROM d_docparsed
          WHERE contains(lower(label || ' ' || excerpt || ' ' || id), 'tion') AND contains(lower(label || ' ' || excerpt || ' ' || id), 'the') ORDER BY id LIMIT 20)
        SELECT 'title' AS source, id, NULL::DOUBLE AS score FROM box UNION ALL SELECT * FROM (
          SELECT 'content', id, round(score, 6) FROM hits WHERE id NOT IN (SELECT id FROM box) ORDER BY score DESC, id LIMIT 5)""",
)
def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    found = S.hybrid_search(_nodes(spark, sf), _index(spark, sf), "tion the")
    return found.withColumn("score", F.round("score", 6))


# ── vectors ──────────────────────────────────────────────────────────────────


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


_COSINE = """list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.v)"""


@query(
    "cosine_topk",
    f"""WITH q AS (SELECT label, list(a ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS a FROM (
          SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL) GROUP BY label)
        SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT q.label AS query_id, e.vec_id AS id, {_COSINE} AS score,
          row_number() OVER (PARTITION BY q.label ORDER BY {_COSINE} DESC, e.vec_id) AS rank FROM embeddings e, q) WHERE rank <= 10""",
)
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors nearest to the centre of each label."""
    rows = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = rows.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("a"))
    # One value per dimension.
    centres = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "a"))).alias("v"))
    queries = centres.select(F.col("label").alias("query_id"), F.col("v.a").alias("vec"))
    return V.cosine_topk(_vectors(spark, sf), queries, 10).withColumn("score", F.round("score", 6))


@query(
    "similar_notes",
    f"""WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 100 = 0)
        SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {_COSINE} AS score,
          row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_COSINE}, 12) DESC, e.vec_id) AS rank FROM embeddings e JOIN q ON q.vec_id <> e.vec_id) WHERE rank <= 5""",
)
def similar_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Notes like each note whose id is divisible by 100, from all notes."""
    vecs = _vectors(spark, sf)
    return V.similar(vecs, vecs.filter("id % 100 = 0")).withColumn("score", F.round("score", 6))


@query("similar_corpus")
def similar_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Notes like every note, by buckets of random hyperplanes."""
    return V.similar_corpus(_vectors(spark, sf)).withColumn("score", F.round("score", 6))


def _crc32_sql(word: str) -> str:
    """CRC-32 of the UTF-8 bytes of a column."""
    code = f"CAST('0x' || substr(hex(encode({word})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)"
    rounds = "list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, octet_length(encode({word}))), lambda i: {code}))"
    return f"xor(4294967295, list_reduce({codes}, lambda a, b: {rounds}))"


_BLANK_SQL = r"[\x09-\x0D\x20\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def _hashed_sql(name: str, texts: str, dim: int = 384) -> str:
    """Tables `name`_x(id, slot, x): the vectors of `texts(id, text)`, rounded to single precision, without zeros."""
    return rf"""
        {name}_w AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_split_to_array(lower(text), '{_BLANK_SQL}')) AS w FROM ({texts})) WHERE w <> '' GROUP BY ALL),
        {name}_c AS (SELECT w, {_crc32_sql('w')} AS c FROM (SELECT DISTINCT w FROM {name}_w)),
        {name}_s AS (SELECT id, c % {dim} AS slot, sum(CASE WHEN c & 65536 > 0 THEN n ELSE -n END) AS x FROM {name}_w JOIN {name}_c USING (w) GROUP BY ALL),
        {name}_x AS (SELECT id, slot, CAST(CAST(x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS x FROM {name}_s WHERE x <> 0)"""


_NOTE_TEXT = "SELECT doc_id AS id, 'doc ' || doc_id || ' doc ' || doc_id || chr(10) || coalesce(text, '') AS text FROM documents"
_ASKED_TEXT = "SELECT doc_id AS id, 'doc ' || doc_id || ' ' || left(coalesce(text, ''), 200) AS text FROM documents WHERE doc_id % 100 = 0"


@query(
    "similar_to_text",
    f"""WITH {_hashed_sql('v', _NOTE_TEXT)}, {_hashed_sql('q', _ASKED_TEXT)},
        vn AS (SELECT id, sqrt(sum(x * x)) AS n FROM v_x GROUP BY id), qn AS (SELECT id, sqrt(sum(x * x)) AS n FROM q_x GROUP BY id),
        dots AS (SELECT q.id AS query_id, v.id AS id, sum(q.x * v.x) AS dot FROM q_x q JOIN v_x v USING (slot) GROUP BY ALL),
        every AS (SELECT q.id AS query_id, v.id AS id, round(coalesce(dot, 0) / q.n / v.n, 12) AS score FROM qn q JOIN vn v ON q.id <> v.id
                  LEFT JOIN dots d ON d.query_id = q.id AND d.id = v.id)
        SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM every)
        WHERE rank <= 5""",
)
def similar_to_text(spark: SparkSession, sf: str) -> DataFrame:
    """Notes like the title and opening of each document whose id is divisible by 100, from all documents."""
    docs = table(spark, sf, "documents")
    label = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    text = F.coalesce("text", F.lit(""))
    notes = docs.select(F.col("doc_id").alias("id"), F.lit(0).alias("mtime"), label.alias("label"), text.alias("content"), text.alias("excerpt"))
    model = V.hashed_embedder()
    vecs = cut(V.embed(V.embedding_text(notes), model, "hashed"))
    found = V.similar_to_text(vecs, notes.filter("id % 100 = 0"), model)
    return found.withColumn("score", F.round("score", 6))


def _embedding_notes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents as notes; judged documents are cached, current only if the judgement is good, and so is one that is gone."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "events"), F.col("doc_id") == F.col("event_id"))
    label = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    notes = docs.select(F.col("doc_id").alias("id"), F.col("ts").alias("mtime"), label.alias("label"), F.col("text").alias("content"))
    judged = table(spark, sf, "labels").join(notes, F.col("doc_id") == F.col("id"))
    mtime = F.when(F.col("quality") == 1, F.col("mtime")).otherwise(F.col("mtime") - F.expr("INTERVAL 1 DAY"))
    gone = F.when(F.col("toxic") == 1, -F.col("id") - 1).otherwise(F.col("id"))
    cache = judged.select(
        gone.alias("id"), mtime.alias("mtime"), F.lit("hashed").alias("model"), F.lit(1).alias("version"),
        F.array(F.lit(1.0)).cast("array<float>").alias("vec"),
    )
    return cache, notes


@query("embedding_delta", "SELECT doc_id AS id FROM documents JOIN events ON event_id = doc_id WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def embedding_delta(spark: SparkSession, sf: str) -> DataFrame:
    return V.embedding_delta(*_embedding_notes(spark, sf)).select("id")


@query("stale_entries", "SELECT doc_id AS id FROM labels JOIN documents USING (doc_id) JOIN events ON event_id = doc_id WHERE toxic = 0")
def stale_entries(spark: SparkSession, sf: str) -> DataFrame:
    return V.drop_stale(*_embedding_notes(spark, sf)).select("id")


@query(
    "refresh_embeddings",
    f"""WITH {_hashed_sql('v', "SELECT id, text FROM (" + _NOTE_TEXT + ") JOIN events ON event_id = id")},
        sums AS (SELECT id, round(sum((slot + 1) * x), 3) AS weighed FROM v_x GROUP BY id),
        old AS (SELECT doc_id AS id FROM labels WHERE quality = 1 AND toxic = 0)
        SELECT doc_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS mtime, CASE WHEN doc_id IN (SELECT id FROM old) THEN 1 ELSE 384 END AS dim,
          CASE WHEN doc_id IN (SELECT id FROM old) THEN 1.0 ELSE coalesce(weighed, 0.0) END AS weighed
        FROM documents JOIN events ON event_id = doc_id LEFT JOIN sums ON id = doc_id""",
)
def refresh_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    cache, notes = _embedding_notes(spark, sf)
    done = V.refresh_embeddings(cache, notes, V.hashed_embedder(384), "hashed")
    weighed = F.aggregate(F.transform("vec", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return done.select("id", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss").alias("mtime"), F.size("vec").alias("dim"), F.round(weighed, 3).alias("weighed"))


@query(
    "embedding_cache",
    """SELECT vec_id AS id, 'first' AS model, CAST(embedding[1] AS DOUBLE) AS x, len(embedding) AS dim FROM embeddings
        UNION ALL SELECT vec_id, 'second', -CAST(embedding[1] AS DOUBLE), len(embedding) FROM embeddings""",
)
def embedding_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Two models saved one after the other into one cache, and both read back."""
    path = f"{checkpoint_root(spark)}/corpusgraph-{uuid.uuid4().hex}/cache"
    for model, sign in (("first", 1.0), ("second", -1.0)):
        vec = F.transform("vec", lambda x: (x * F.lit(sign)).cast("float"))  # noqa: B023
        rows = _vectors(spark, sf).select("id", F.lit(0).alias("mtime"), F.lit(model).alias("model"), F.lit(1).alias("version"), vec.alias("vec"))
        V.save_embeddings(rows, path)
    both = V.load_embeddings(spark, path, "first", 1).unionByName(V.load_embeddings(spark, path, "second", 1))
    return both.select("id", "model", F.col("vec")[0].cast("double").alias("x"), F.size("vec").cast("long").alias("dim"))


@query(
    "enrich_hits",
    """SELECT e.vec_id AS id, coalesce('doc ' || d.doc_id, CAST(e.vec_id AS VARCHAR)) AS label, coalesce(left(d.text, 120), '') AS excerpt
        FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id""",
)
def enrich_hits(spark: SparkSession, sf: str) -> DataFrame:
    nodes = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("label"), F.substring("text", 1, 120).alias("excerpt")
    )
    return S.enrich(_vectors(spark, sf).select("id"), nodes).select("id", "label", "excerpt")


# ── rich text ────────────────────────────────────────────────────────────────


def _rich(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as rich-text trees: a heading, a paragraph per line, a closing paragraph with a link."""
    line = F.transform(
        F.split("text", "\n"),
        lambda s: F.concat(
            F.lit('{"type":"paragraph","children":['),
            F.to_json(F.struct(F.lit("text").alias("type"), s.alias("text"), (F.length(s) % 4).alias("format"))),
            F.lit("]}"),
        ),
    )
    key = F.col("doc_id").cast("string")
    content = F.concat(
        F.lit('{"root":{"type":"root","children":[{"type":"heading","tag":"h3","children":[{"type":"text","text":"'), "lang",
        F.lit('"}]},'), F.array_join(line, ","),
        F.lit(',{"type":"paragraph","children":[{"type":"text","text":"see "},{"type":"link","fields":{"url":"https://news.example/doc-'), key,
        F.lit('"},"children":[{"type":"text","text":"'), "source", F.lit('"}]}]}]}}'),
    )
    return K.documents(spark, sf).select("doc_id", content.alias("content"))


@query(
    "richtext_text",
    r"""SELECT doc_id, trim(regexp_replace(lang || ' ' || text || ' see ' || source, '[\s\x{00a0}\x{2000}-\x{200a}\x{3000}]+', ' ', 'g')) AS text FROM documents""",
)
def richtext_text(spark: SparkSession, sf: str) -> DataFrame:
    return RT.richtext_text(RT.rt_nodes(_rich(spark, sf)))


@query(
    "richtext_blocks",
    r"""SELECT doc_id, 2::BIGINT AS block, 'heading' AS type, 3::BIGINT AS level, lang AS text, 0::BIGINT AS marks FROM documents
        UNION ALL SELECT doc_id, 4 + 2 * i, 'paragraph', 0, regexp_replace(line, '^\s+|\s+$', '', 'g'), length(line) % 4 FROM (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i FROM documents)
        UNION ALL SELECT doc_id, 4 + 2 * len(string_split(text, chr(10))), 'paragraph', 0, 'see ' || source, 0 FROM documents""",
)
def richtext_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = RT.richtext_blocks(RT.rt_nodes(_rich(spark, sf)))
    level = F.coalesce("level", F.lit(0)).cast("long")
    return rows.select("doc_id", F.col("block").cast("long").alias("block"), "type", level.alias("level"), "text", F.col("marks").cast("long").alias("marks"))


@query(
    "richtext_links",
    """SELECT doc_id, 'https://news.example/doc-' || doc_id AS url, source AS label,
          CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'judged ' || doc_id ELSE 'https://news.example/doc-' || doc_id END AS target FROM documents""",
)
def richtext_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links found in the trees, resolved to judged documents where they exist."""
    links = RT.richtext_links(RT.rt_nodes(_rich(spark, sf)))
    links = links.withColumn("slug", T.internal_slug(F.col("url"), ["news.example"]))
    key = F.col("doc_id").cast("string")
    names = table(spark, sf, "labels").select(F.concat(F.lit("doc-"), key).alias("slug"), F.concat(F.lit("judged "), key).alias("note"))
    return RT.resolve_links(links, names).select("doc_id", "url", "label", "target")


@query(
    "resolve_links",
    """SELECT page_id AS doc_id, h AS url, coalesce(note, h) AS target FROM (
          SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="(/[^"/?#]+)"', 1)) AS h FROM pages)
        LEFT JOIN (SELECT word, min(note) AS note FROM (SELECT regexp_extract(text, '^(\\S+)', 1) AS word, source || ' ' || doc_id AS note FROM documents)
          WHERE word <> '' GROUP BY word) ON word = substr(h, 2)""",
)
def resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = F.array_distinct(F.regexp_extract_all("html", F.lit('href="(/[^"/?#]+)"'), F.lit(1)))
    links = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.explode(hrefs).alias("url"))
    links = links.withColumn("slug", T.internal_slug(F.col("url"), ["news.example"]))
    note = F.concat("source", F.lit(" "), F.col("doc_id").cast("string"))
    names = table(spark, sf, "documents").select(F.regexp_extract("text", r"^(\S+)", 1).alias("slug"), note.alias("note"))
    names = names.filter("slug <> ''").groupBy("slug").agg(F.min("note").alias("note"))
    return RT.resolve_links(links, names).select("doc_id", "url", "target")


# ── streams ──────────────────────────────────────────────────────────────────


def _stream(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """The events as a stream of four batches, each over the whole time, and a fresh folder for outputs."""
    events = table(spark, sf, "events")
    root = f"{checkpoint_root(spark)}/corpusgraph-stream-{uuid.uuid4().hex}"
    for batch in range(4):  # one after the other: a file source takes the oldest first
        events.filter(F.col("event_id") % 4 == batch).coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    return source.withColumn("ts", F.col("ts").cast("timestamp")), root


@query("stream_upsert", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    source, root = _stream(spark, sf)
    J.stream_upsert(source, f"{root}/out", "user_id", [F.desc("ts"), F.desc("event_id")], f"{root}/state").awaitTermination()
    return J.current(spark, f"{root}/out").select("user_id", "event_id", "event_type")


# What batches 0 to 3 know of time when they begin.
_SEEN = """seen AS (SELECT b, (SELECT max(ts) FROM events WHERE event_id % 4 < b) - INTERVAL 2 DAY AS mark FROM (SELECT unnest([0, 1, 2, 3]) AS b))"""


@query(
    "stream_daily",
    f"""WITH {_SEEN} SELECT strftime(d, '%Y-%m-%d') AS day, event_type AS kind, n, late, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY d) AS BIGINT) AS total
        FROM (SELECT date_trunc('day', ts) AS d, event_type, count(*) AS n, count(*) FILTER (WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark) AS late
              FROM events JOIN seen ON b = event_id % 4 GROUP BY ALL)""",
)
def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    source, root = _stream(spark, sf)
    J.stream_daily(source, "ts", "event_type", "2 days", f"{root}/out", f"{root}/state").awaitTermination()
    counts = J.running_totals(J.window_counts(spark, f"{root}/out"))
    return counts.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "kind", "n", "late", "total")


@query(
    "stream_trailing",
    f"""WITH {_SEEN}, w AS (SELECT b, event_type, date_trunc('day', ts) - i * INTERVAL 1 DAY AS start FROM events JOIN (SELECT event_id, event_id % 4 AS b FROM events) USING (event_id),
          generate_series(0, 6) g(i))
        SELECT strftime(start, '%Y-%m-%d') AS start, event_type AS kind, count(*) AS n, count(*) FILTER (WHERE start + INTERVAL 7 DAY <= mark) AS late
        FROM w JOIN seen USING (b) GROUP BY ALL""",
)
def stream_trailing(spark: SparkSession, sf: str) -> DataFrame:
    source, root = _stream(spark, sf)
    J.stream_trailing(source, "ts", "event_type", "2 days", f"{root}/out", f"{root}/state").awaitTermination()
    counts = J.window_counts(spark, f"{root}/out")
    return counts.select(F.date_format("start", "yyyy-MM-dd").alias("start"), "kind", "n", "late")
