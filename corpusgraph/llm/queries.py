"""One query per operator: each applies it to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut_light as cut, discard
from corpusgraph.llm import (
    byte_bpe, chat_format, conversation_repair, decontaminate, language_id, lexical_search, ngram_join, pii, quality_classifier, quality_rules,
    suffix_dedup, url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), into="found", keep=["doc_id"])
    spans = F.col("found.spans")
    base = F.filter(spans, lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(spans).alias("spans"))


OP8 = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""


@query("op8_decontaminate", OP8)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    leak = decontaminate.decontaminate(docs, items, into="leak", keep=["doc_id"])
    return leak.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = byte_bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, into="tokens", keep=["doc_id"])
    return out.select(
        "doc_id", "tokens.n_tokens", F.sha2("tokens.ids", 256).alias("ids_sha256"), F.sha2("tokens.decoded", 256).alias("decoded_sha256")
    )


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[f"stats.{c}" for c in counts], "base_failed", "kept")


_SAMPLE = "</s>[INST] ok [/INST]"

OP7 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SAMPLE}' UNION ALL SELECT -1, 1, 'assistant', '{_SAMPLE}'),
e AS (
  SELECT *, length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), '|', '&vert;')) AS n_text,
         length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), '|', '&vert;')) AS n_role
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n_text + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 8 ELSE n_role + 13 END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op7_chat_format", OP7)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sample = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_SAMPLE).alias("text"),
    )
    made = chat_format.format_conversations(rows.unionByName(sample))
    back = made.select("conv", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


@query("op9_warc", OP9)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    read = warc.read_records(index)
    rows = cut(read.select(
        "page_id", "record_type", "refers_to", "digest",
        F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("own_digest"),
    ))
    # A revisit has no payload of its own: its size comes from the response with the same digest.
    stored = rows.filter("record_type = 'response'").select(F.col("own_digest").alias("digest"), "n_bytes")
    sizes = stored.groupBy("digest").agg(F.max("n_bytes").alias("payload_bytes"))
    responses = rows.filter("record_type = 'response'").select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    revisits = rows.filter("record_type = 'revisit'").join(sizes, "digest").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.unionByName(revisits)


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.learn(docs, labels)
    scored = quality_classifier.score(docs, model, into="score", keep=["doc_id"])
    held_out = quality_classifier.held_out(F.col("doc_id"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    net = language_id.learn(docs.filter(learned))
    found = language_id.identify(docs, net, into="found", keep=["doc_id"])
    return found.select("doc_id", F.coalesce(~learned, F.lit(False)).alias("held_out"), "found.lang_pred", "found.score")


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
q AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
qt AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM q) GROUP BY q, t),
s AS (SELECT count(*) AS n_all, CAST(sum(len(w)) AS BIGINT) AS l_all FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY r, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
impacts AS (
  SELECT r, t, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * n_all) // l_all))) AS impact
  FROM p JOIN d USING (r) JOIN weights USING (t), s),
scores AS (SELECT q, r, CAST(sum(impact * times) AS BIGINT) AS score FROM impacts JOIN qt USING (t) GROUP BY q, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
      FROM scores JOIN d USING (r) WHERE score > 0) JOIN q USING (q)
WHERE rank <= 20
"""


@query("op11_lexical_search", OP11)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = cut(lexical_search.build_index(table(spark, sf_dir, "documents")))
    found = lexical_search.search(index, table(spark, sf_dir, "benchmark"))
    discard(index)
    return found


URL_RULES = (
    url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


def _op12_sql(tree: url_filter.Tree) -> str:
    sql = """
WITH parsed AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
bad AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS given FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed LEFT JOIN bad ON doc_id = TRY_CAST(NULLIF(regexp_extract(path, '/([0-9]{1,18})(\\.html)?/?$', 1), '') AS BIGINT)),
labelled AS (
  SELECT r, page_id, host, path, rule, host AS node, list_filter(string_split(path, '/'), lambda s: s <> '')[1:$LEVELS] AS segs,
         CAST(coalesce(CASE WHEN rule IN ('net/', 'example.com/de/') THEN TRUE WHEN rule IS NOT NULL THEN FALSE END, given) AS INTEGER) AS bad
  FROM ruled),
overall AS (SELECT (coalesce(sum(bad), 0) + 1) / (count(bad) + 2) AS prior FROM labelled),
l0 AS (
  SELECT r, node, segs, bad, n_labelled, purity FROM labelled JOIN (
    SELECT node, count(bad) AS n_labelled, (coalesce(sum(bad), 0) + $STRENGTH * prior) / (count(bad) + $STRENGTH) AS purity
    FROM labelled, overall GROUP BY node, prior) USING (node))"""
    for i in range(1, tree.levels + 1):
        sql += f""",
s{i} AS (SELECT *, segs[{i}] AS seg FROM l{i - 1}),
c{i} AS (SELECT node, seg, max(purity) AS parent, count(*) AS n, count(bad) AS l, coalesce(sum(bad), 0) AS b FROM s{i} WHERE seg IS NOT NULL GROUP BY node, seg),
k{i} AS (SELECT *, n >= $LEAST AND n * 100 >= sum(n) OVER (PARTITION BY node) * $PERCENT AS literal FROM c{i}),
b{i} AS (SELECT node, seg, parent, l, b FROM k{i} WHERE literal UNION ALL
       SELECT node, NULL, max(parent), sum(l), sum(b) FROM k{i} WHERE NOT literal GROUP BY node),
m{i} AS (SELECT *, l >= $MERGE AS ready, CASE WHEN l >= $MERGE THEN b / l END AS share FROM b{i}),
a{i} AS (SELECT *, lag(l) OVER w AS l0, lag(b) OVER w AS b0 FROM m{i} WINDOW w AS (PARTITION BY node, ready ORDER BY share, seg NULLS FIRST)),
e{i} AS (SELECT *, sqrt((b + b0 + 1) / (l + l0 + 2) * (1 - (b + b0 + 1) / (l + l0 + 2)) * (1 / l + 1 / l0)) AS error FROM a{i}),
g{i} AS (SELECT *, sum(CASE WHEN ready AND NOT coalesce(share - b0 / l0 > $ERRORS * error, TRUE) THEN 0 ELSE 1 END)
         OVER (PARTITION BY node, ready ORDER BY share, seg NULLS FIRST ROWS UNBOUNDED PRECEDING) AS grp FROM e{i}),
n{i} AS (SELECT node, seg,
         node || '/' || array_to_string(list_sort(list(coalesce(regexp_replace(seg, '([*|\\\\])', '\\\\\\1', 'g'), '*')) OVER w), '|') AS next,
         sum(l) OVER w AS n_labelled, (sum(b) OVER w + $STRENGTH * parent) / (sum(l) OVER w + $STRENGTH) AS purity
       FROM g{i} WINDOW w AS (PARTITION BY node, ready, grp)),
l{i} AS (SELECT s.r, coalesce(x.next, y.next, s.node) AS node, s.segs, s.bad,
              CASE WHEN s.seg IS NULL THEN s.n_labelled WHEN x.node IS NOT NULL THEN x.n_labelled ELSE y.n_labelled END AS n_labelled,
              CASE WHEN s.seg IS NULL THEN s.purity WHEN x.node IS NOT NULL THEN x.purity ELSE y.purity END AS purity
       FROM s{i} s LEFT JOIN n{i} x ON s.node = x.node AND s.seg = x.seg LEFT JOIN n{i} y ON s.seg IS NOT NULL AND s.node = y.node AND y.seg IS NULL)"""
    sql += f"""
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN n_labelled >= $REJECT_LEAST AND purity >= $REJECT THEN 'block' ELSE 'allow' END AS verdict,
       l{tree.levels}.node AS template, round(purity, 9) AS purity
FROM labelled JOIN l{tree.levels} USING (r)
"""
    names = {
        "$LEVELS": tree.levels, "$STRENGTH": tree.strength, "$LEAST": tree.literal_least, "$PERCENT": tree.literal_percent, "$MERGE": tree.merge_least,
        "$ERRORS": tree.merge_errors, "$REJECT_LEAST": tree.reject_least, "$REJECT": tree.reject_purity,
    }
    for name in sorted(names, key=len, reverse=True):
        sql = sql.replace(name, f"CAST({names[name]} AS DOUBLE)" if isinstance(names[name], float) else str(names[name]))
    return sql


@query("op12_url_filter", _op12_sql(url_filter.Tree()))
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The last number of a page's address names the document it shows, whose labels are the page's.
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]{1,18})(\.html)?/?$", 1)
    pages = pages.withColumn("shows", number.try_cast("bigint"))
    bad = F.max((F.col("quality") == 0) | (F.col("toxic") == 1))
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("shows")).agg(bad.alias("bad"))
    judged = url_filter.judge_urls(pages.join(labels, "shows", "left"), URL_RULES, label="bad", into="judged")
    fields = ["host", "path", "rule", "verdict", "template"]
    return judged.select("page_id", *[f"judged.{c}" for c in fields], F.round("judged.purity", 9).alias("purity"))


def _op13_sql() -> str:
    follows, name = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    moves = []
    for state in range(4):
        moves.append((state, "D", "", state, 4, "D", ""))
        if state == 0:
            moves.append((state, "K", "s", 1, 0, "K", ""))
        at, text = state, ""
        for k in range(3):
            to = follows[at]
            moves.append((state, "K", name[to][0], to, 3 * k, "I" * k + "K", text))
            moves.append((state, "R", "", to, 3 * k + 3, "I" * k + "R", text))
            at, text = to, f"{text}{name[to]}:\n"
    values = ", ".join(f"({s}, '{e}', '{i}', {to}, {c}, '{a}', '{t}')" for s, e, i, to, c, a, t in moves)
    return f"""
WITH RECURSIVE moves(st, edit, initial, dest, price, letters, ins) AS (VALUES {values}),
own AS (
  SELECT conv_id AS c, turn AS t, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 20 AS kind
  FROM own),
rows AS (
  SELECT c, t, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) FROM hashed) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY t NULLS FIRST, role, text) AS i FROM rows),
faults AS (
  SELECT *, left(role, 1) AS initial, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
         row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed),
judged AS (
  SELECT *, last = '' AS blank, last <> '' AND again AS duplicate, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
         before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM faults),
walk AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST(NULL AS VARCHAR) AS rep FROM own
  UNION ALL
  SELECT c, i, st, cost, audit, rep FROM (
    SELECT w.c, r.i, m.dest AS st, w.cost + m.price + CASE WHEN r.truncated AND m.edit <> 'D' THEN 3 ELSE 0 END AS cost, w.audit || m.letters AS audit,
           CASE WHEN m.edit = 'D' THEN w.rep ELSE coalesce(w.rep || chr(10), '') || m.ins ||
             CASE WHEN m.edit = 'K' THEN r.role WHEN m.dest = 2 THEN 'user' ELSE 'assistant' END || ':' || r.text END AS rep
    FROM walk w JOIN judged r ON r.c IS NOT DISTINCT FROM w.c AND r.i = w.i + 1
         JOIN moves m ON m.st = w.st AND (m.edit = 'D' OR NOT (r.blank OR r.duplicate) AND (m.edit = 'R' OR m.initial = r.initial)))
  QUALIFY row_number() OVER (PARTITION BY c, i, st ORDER BY cost, audit) = 1),
counts AS (
  SELECT c, CAST(coalesce(max(t) - min(t) + 1, 0) - count(DISTINCT t) AS BIGINT) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal,
         count(*) AS n
  FROM judged GROUP BY c),
closed AS (
  SELECT w.c, cost + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS cost, audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
         CASE st WHEN 1 THEN rep || chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN rep || chr(10) || 'assistant:' ELSE coalesce(rep, '') END AS rep
  FROM walk w LEFT JOIN counts n ON n.c IS NOT DISTINCT FROM w.c
  WHERE w.i = coalesce(n.n, 0)),
ends AS (SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost, audit) = 1)
SELECT e.c AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(rep) AS repaired_sha256
FROM ends e LEFT JOIN counts n ON n.c IS NOT DISTINCT FROM e.c
"""


@query("op13_conversation_repair", _op13_sql())
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
