"""From raw documents to token ids in five stages, each written and read again before the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.scale import checkpoint_root
from corpusgraph.llm import byte_bpe, decontaminate, familiarity, language_id, ngram_join, pii
from corpusgraph.llm.quality_classifier import held_out

RANKS = "byte_bpe_50k.tiktoken"

#: SQL cannot express recurrent networks and byte-pair merges.
ORACLE_SQL = None


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, garbled and foreign ones, and those whose language stays unclear.

    The network learns from the labelled four fifths, as do the bounds by length on its score above chance and on how
    familiar the letters are; without any label nothing can be told, and all rows stay.
    """
    learned = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    net = language_id.learn(learned)
    if net is None:
        return docs
    into = _unused(docs, "_language")
    found = language_id.identify(docs, net, into=into)
    clear = F.col(f"{into}.lang_pred") != language_id.UNKNOWN
    known = familiarity.learn(learned)
    if known is not None:
        tested = language_id.identify(familiarity.find(familiarity.uncounted(learned), known, into="f"), net, into="l", keep=["lang", "f"])
        chance = 1 / len(net.langs)
        least = familiarity.least(tested, F.col("l.score") - chance, F.col("f.letters"))
        own = _unused(found, "_familiar")
        found = familiarity.find(found, known, into=own)
        # Place 0 of the bounds is for no letter, which is rejected anyway.
        bound = F.element_at(F.array(*map(F.lit, least[1:].tolist())), F.length(F.bin(f"{own}.letters")))
        clear &= F.col(f"{own}.clear") & (F.col(f"{into}.score") - chance >= bound)
        return found.filter(clear).drop(into, own)
    return found.filter(clear).drop(into)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates, and one of rows that repeat an id and text.

    Texts without words, and rows without an id, are in no group and stay.
    """
    groups = ngram_join.jaccard_components(docs, digested=True)
    names = [f"`{c}`" for c in docs.columns]
    surplus = groups.filter("doc_id IS NOT NULL AND component_id <> doc_id").select("doc_id", "one", "two").distinct()
    repeated = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not repeated.head(1):
        return docs.join(surplus.select("doc_id"), "doc_id", "left_anti").select(*names)
    single = docs.join(repeated, "doc_id", "left_anti").join(surplus.select("doc_id"), "doc_id", "left_anti").select(*names)
    # An id may stand for several texts; each goes or stays by its own digest.
    own = _unused(docs, "_set")
    several = docs.join(repeated, "doc_id", "left_semi")
    several = ngram_join.digests(several.select(F.struct(*names).alias(own), "doc_id", "text"))
    several = several.join(surplus, ["doc_id", "one", "two"], "left_anti")
    once = several.filter("one IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(several.filter("one IS NULL"))
    return single.unionByName(once.select(f"{own}.*")).select(*names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    into = _unused(docs, "_leak")
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=into)
    return found.filter(F.col(f"{into}.n_hit") == 0).drop(into)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars follows the new text."""
    into = _unused(docs, "_pii")
    found = pii.find_personal_data(docs, masked=True, into=into)
    changed = F.size(f"{into}.spans") > 0
    text = F.when(changed, F.col(f"{into}.masked")).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.drop(into)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (decimal, one space between), and whether decoding gives the text again."""
    path = public_tokenizers.path(RANKS)
    into = _unused(docs, "_tokens")
    out = byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN, into=into)
    same = F.col(f"{into}.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "lang", "source", f"{into}.n_tokens", f"{into}.ids", same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's table lies in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_root(spark)}/corpusgraph-pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
