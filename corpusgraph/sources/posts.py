"""Article records: cached JSON, landed API pages, normalised fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions.text import WS

POST = (
    "id long, slug string, title string, content variant, publishedAt string, excerpt string,"
    " categories variant, populatedAuthors variant, authors variant, tags variant, relatedPosts variant,"
    " site string, _status string, wpId long"
)
PAGE = f"docs array<struct<{', '.join(f'`{c.split()[0]}`: {c.split()[1]}' for c in POST.split(', '))}>>, totalPages long, totalDocs long, hasNextPage boolean"


def read_posts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Posts from JSON array files; `lines` reads one post per line, which splits large files."""
    return spark.read.schema(POST).option("multiLine", not lines).json(path)


def read_pages(spark: SparkSession, path: str, site: str | None = None, limit: int | None = None) -> DataFrame:
    """Published posts of landed API pages, newest first."""
    pages = spark.read.schema(PAGE).option("recursiveFileLookup", True).json(path)
    posts = pages.select(F.inline("docs")).filter("_status = 'published'")
    if site is not None:
        posts = posts.filter(F.col("site") == site)
    newest = posts.orderBy(F.desc("publishedAt"), F.asc("id"))
    return newest if limit is None else newest.limit(limit)


def _labels(col: str, *keys: str) -> Column:
    """Array of scalars or objects → array of names, empties dropped."""
    def label(v: Column) -> Column:
        named = [F.try_variant_get(v, f"$.{k}", "string") for k in keys]
        is_object = F.schema_of_variant(v).startswith("OBJECT")
        return F.when(is_object, F.coalesce(*named)).otherwise(F.try_variant_get(v, "$", "string"))

    items = F.transform(F.try_variant_get(col, "$", "array<variant>"), label)
    return F.coalesce(F.filter(items, lambda t: t.isNotNull() & (t != "")), F.array().cast("array<string>"))


def normalise_posts(posts: DataFrame) -> DataFrame:
    """doc_id, slug, title, content, published_at, excerpt, categories, authors, tags, related, site."""
    authors = F.coalesce(F.nullif(_given("populatedAuthors"), F.lit("")), F.lit(""))
    named = F.when(authors != "", _labels("populatedAuthors", "name", "title")).otherwise(_labels("authors", "name", "title"))
    related = F.filter(
        F.transform(
            F.try_variant_get("relatedPosts", "$", "array<variant>"),
            lambda v: F.struct(
                F.try_variant_get(v, "$.slug", "string").alias("slug"),
                F.try_variant_get(v, "$.title", "string").alias("title"),
                F.schema_of_variant(v).startswith("OBJECT").alias("_object"),
            ),
        ),
        lambda r: r["_object"],
    )
    related = F.transform(related, lambda r: F.struct(r["slug"].alias("slug"), r["title"].alias("title")))
    return posts.select(
        F.col("id").alias("doc_id"),
        "slug",
        "title",
        "content",
        F.col("publishedAt").alias("published_at"),
        F.trim(F.regexp_replace("excerpt", r"\n+", " ")).alias("excerpt"),
        _labels("categories", "title").alias("categories"),
        F.filter(F.transform(F.try_variant_get("categories", "$", "array<variant>"), _category_id), F.isnotnull).alias("category_ids"),
        named.alias("authors"),
        F.transform(_labels("tags", "title"), lambda t: F.regexp_replace(t, f"{WS}+", "-")).alias("tags"),
        F.coalesce(related, F.array().cast("array<struct<slug:string,title:string>>")).alias("related"),
        "site",
        F.col("wpId").alias("wp_id"),
    )


def _given(col: str) -> Column:
    """JSON text of a list that is present and not null."""
    text = F.to_json(col)
    return F.when(text == "null", "").otherwise(F.coalesce(text, F.lit("")))


def _category_id(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$.id", "long"), F.try_variant_get(v, "$", "long"))
