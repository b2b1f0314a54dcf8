"""Blanks of every kind at the ends of names and links, and caches that hold several models."""

from pyspark.sql import functions as F

from corpusgraph.operators import corpus, notes, resolve, vectors


def test_blanks_are_trimmed(spark):
    body = "#\tTitle \r\n[[\tFoo bar ]] and [[a|b]]"
    frame = spark.createDataFrame([(body, "x/y.md", " Ann Lee\t")], "body string, path string, name string")
    row = frame.select(
        notes.note_title(F.col("body"), F.col("path")).alias("title"), notes.wikilinks(F.col("body")).alias("links"),
        resolve.canonical_name(F.col("name"), ("Mr",)).alias("name"), F.regexp_extract(F.lit("Part 1"), corpus.PART, 1).alias("part"),
    ).first()
    assert (row.title, row.links, row.name, row.part) == ("Title", ["foo-bar", "a"], "Ann Lee", "1")


def test_saving_keeps_other_models(spark, tmp_path):
    path = str(tmp_path / "cache")
    schema = "id string, mtime long, model string, version int, vec array<float>"
    vectors.save_embeddings(spark.createDataFrame([("a", 1, "m1", 1, [1.0])], schema), path)
    vectors.save_embeddings(spark.createDataFrame([("b", 1, "m2", 1, [2.0])], schema), path)
    vectors.save_embeddings(vectors.load_embeddings(spark, path, "m2", 1), path)
    assert [r.id for r in vectors.load_embeddings(spark, path, "m1", 1).collect()] == ["a"]
    assert [r.id for r in vectors.load_embeddings(spark, path, "m2", 1).collect()] == ["b"]


def test_model_runs_once(spark):
    cache = spark.createDataFrame([], "id string, mtime long, model string, version int, vec array<float>")
    texts = spark.createDataFrame([("a", 1, "l", "c")], "id string, mtime long, label string, content string")
    plan = vectors.refresh_embeddings(cache, texts, lambda batch: [[1.0] for _ in batch], "m")
    assert "MapInPandas" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == 1


def test_long_runs_of_blanks_take_no_longer(spark):
    import time

    from pyspark.sql import functions as F

    from corpusgraph.functions.text import internal_slug, last_word, trim_blanks
    from corpusgraph.operators.extract import sentences

    run = "  \n\t" * 25_000
    texts = [f"a{run}b{run}", run, f"{run}x", "y" * 100_000 + " z", "https://news.example/" + "/" * 100_000 + "s/"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    frame.count()
    start = time.perf_counter()
    got = frame.select(trim_blanks(F.col("text")).alias("t"), last_word(F.col("text")).alias("w"), internal_slug(F.col("text"), ["news.example"]).alias("s")).collect()
    assert [r.t for r in got] == [f"a{run}b", "", "x", "y" * 100_000 + " z", texts[4]]
    assert [r.w for r in got] == ["", "", "x", "z", texts[4]] and got[4].s == "s"
    assert [r.sentence for r in sentences(frame.limit(3)).collect()] == [f"a{run}b", "", "x"]
    assert time.perf_counter() - start < 10
