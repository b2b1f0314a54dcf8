"""Repeats of any length, recall of personal data, clashing names, and reading archives in many tasks."""

import random

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("length", [64, 129, 200])
def test_repeats_of_any_length(spark, length):
    from corpusgraph.llm import suffix_dedup

    rng = random.Random(length)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(150, 700))) for _ in range(8)]
    texts = []
    for _ in range(60):
        passage = list(rng.choice(passages))
        for _ in range(rng.randint(0, 2)):  # differs in one place, often far from both ends
            passage[rng.randrange(len(passage))] = "#"
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) + "".join(passage) + "".join(rng.choice(letters) for _ in range(30)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs, length=length).collect()}
    seen: set[bytes] = set()
    for i, text in enumerate(texts):
        raw = text.encode()
        gone = bytearray(len(raw))
        for o in range(len(raw) - length + 1):
            if raw[o : o + length] in seen:
                gone[o : o + length] = b"\1" * length
            seen.add(raw[o : o + length])
        assert got[i] == bytes(x for x, y in zip(raw, gone, strict=True) if not y)


def test_segments_with_any_byte_changed_differ():
    import numpy as np

    from corpusgraph.llm import suffix_dedup

    rng = np.random.default_rng(1)
    for length in (100, 160, 400):
        raw = rng.integers(97, 122, length).astype(np.uint8)
        mark = {int(suffix_dedup.segments(raw, np.array([0, length]), length)[1][0])}
        for place in range(length):
            other = raw.copy()
            other[place] = 65
            mark.add(int(suffix_dedup.segments(other, np.array([0, length]), length)[1][0]))
        assert len(mark) == length + 1


def test_secrets_behind_underscores():
    from corpusgraph.llm import pii

    for key in ("client_secret=", "access_token: ", "private_key=", "DB_PASSWORD=", "my-api-key: ", "SECRET_KEY='", "apiKey="):
        found = pii.find(f"set {key}abc12345xyz' ok")
        assert [s[0] for s in found] == ["secret"], key
    assert [s[0] for s in pii.find("password=hunterTwoSecret")] == ["secret"]
    for plain in ("password=something", "mytoken=abc12345xyz", "the secret: whatever", "tokens=abc12345xyz"):
        assert pii.find(plain) == []


def test_bank_numbers_end_with_their_country():
    from corpusgraph.llm import pii

    text = "IBAN DE89 3704 0044 0532 0130 00 OK then GB82WEST12345698765432, bank NO93 8601 1117 947 X1 and ZZ00 1234"
    spans = [text[s:e] for kind, s, e, *_ in pii.find(text) if kind == "iban"]
    assert spans == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"]


def test_words_nearby_move_the_score_of_base_kinds():
    from corpusgraph.llm import pii

    listed = pii.find("version 1.2.3.4")
    assert [(s[0], s[3]) for s in listed] == [("ip", True)] and listed[0][4] < 0.5
    assert pii.find("server 1.2.3.4")[0][4] > pii.find("at 1.2.3.4")[0][4] >= 0.5
    work = pii._worker(0.5, True)
    import pyarrow as pa

    out = work(pa.array(["version 1.2.3.4", "server 1.2.3.4", None, ""]))
    assert out.field("masked").to_pylist() == ["version 1.2.3.4", "server [IP]", None, ""]
    assert [len(s) for s in out.field("spans").to_pylist()] == [1, 1, 0, 0]


def test_many_spans_are_compared_in_order():
    import time

    from corpusgraph.llm import pii

    text = "a@b.cd 123-45-6789 token=abc12345 " * 3000
    start = time.perf_counter()
    found = pii.find(text)
    assert time.perf_counter() - start < 5
    assert len([s for s in found if s[0] == "email"]) == 3000 and len([s for s in found if s[0] == "secret"]) == 3000


def test_no_documents(spark):
    from corpusgraph.llm import decontaminate, pii

    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert pii.find_personal_data(docs, masked=True).count() == 0
    for block_bytes in (1, 1 << 20):
        assert decontaminate.decontaminate(docs, items, spans=True, block_bytes=block_bytes).count() == 0


def test_blocks_of_a_benchmark_and_clashing_names(spark):
    from corpusgraph.llm import decontaminate

    names = ["_whole_", "_hits_", "_items_", "_n_", "_both_", "_clean_", "_part0_", "kept", "whole", "hits", "names", "n", "both", "clean", "part0"]
    docs = spark.createDataFrame([(1, "x one two three y", *names), (2, None, *names)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    items = spark.createDataFrame([(1, "one two"), (2, "two three"), (3, "nothing here")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, items, spans=True, block_bytes=4).collect()}
    assert rows[1].leak.n_hit == 3 and rows[1].leak.items == ["1", "2"] and rows[1].leak.clean == "x  y"
    assert [rows[2][c] for c in names] == names and rows[2].leak.n_hit == 0


def test_archives_are_read_by_many_tasks(spark):
    from corpusgraph.llm import warc

    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.repeat(F.lit("<p>"), 200), F.col("id").cast("string")).alias("html"))
    index = warc.write_archives(pages.coalesce(1))
    read = warc.read_records(index)
    assert index.select("file").distinct().count() == 1 and read.rdd.getNumPartitions() > 1
    assert {r.page_id for r in read.filter("length(payload) > 600").collect()} == set(range(400))
    assert warc.read_records(index.limit(0)).count() == 0
