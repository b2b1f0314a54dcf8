"""Skew-safe helpers against brute force."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from corpusgraph.functions.scale import contains_join, paged, ranked, with_neighbours
from corpusgraph.operators.corpus import cooccurrence, symmetric


def _hot(spark):
    """One group holds a third of the rows and more; some groups are null."""
    rng = random.Random(1)
    data = [("hot" if i % 3 else f"g{i % 7}", rng.randrange(50), i) for i in range(900)] + [(None, i, 1000 + i) for i in range(5)]
    return data, spark.createDataFrame(data, "g string, v int, id int").repartition(7)


def test_ranked_equals_row_number(spark):
    data, df = _hot(spark)
    got = {(r.g, r.id): r.rank for r in ranked(df, ["g"], [F.desc("v"), F.asc("id")]).collect()}
    for group in {g for g, _, _ in data}:
        ordered = sorted((r for r in data if r[0] == group), key=lambda r: (-r[1], r[2]))
        assert [got[(group, r[2])] for r in ordered] == list(range(1, len(ordered) + 1))


def test_neighbours_wrap(spark):
    data, df = _hot(spark)
    got = {r.id: (r.p, r.n) for r in with_neighbours(df, ["g"], [F.asc("v"), F.asc("id")], "id", "p", "n").collect()}
    for group in {g for g, _, _ in data}:
        ids = [r[2] for r in sorted((r for r in data if r[0] == group), key=lambda r: (r[1], r[2]))]
        for i, node in enumerate(ids):
            assert got[node] == (ids[i - 1], ids[(i + 1) % len(ids)])


def test_pages_are_bounded_and_whole(spark):
    data, df = _hot(spark)
    pages = paged(df, ["g"], [F.asc("id")], "id", 50, "ids").collect()
    assert max(len(p.ids) for p in pages) == 50
    assert sum(len(p.ids) for p in pages) == len(data)
    hot = [i for p in sorted((p for p in pages if p.g == "hot"), key=lambda p: p.page) for i in p.ids]
    assert hot == sorted(hot)


def test_contains_join_any_pattern_length(spark, rows):
    texts = ["abcabc", "the quick brown fox jumps over it", "x", "", "été ab", "brown fox jumps over"]
    patterns = ["a", "ab", "cab", "brown fox jumps over", "quick brown", "x", "é ", "zzz", ""]
    left = spark.createDataFrame([(t,) for t in texts], "t string")
    right = spark.createDataFrame([(p,) for p in patterns], "p string")
    expected = sorted({(t, p) for t in texts for p in patterns if p and p in t}, key=repr)
    assert rows(contains_join(left, "t", right, "p"), "t", "p") == expected


def test_contains_join_with_key_and_no_patterns(spark, rows):
    left = spark.createDataFrame([("a", "hello"), ("b", "hello")], "k string, t string")
    right = spark.createDataFrame([("a", "ell")], "k string, p string")
    assert rows(contains_join(left, "t", right, "p", ["k"]), "k", "t", "p") == [("a", "hello", "ell")]
    assert contains_join(left, "t", right.limit(0), "p", ["k"]).count() == 0


def test_cooccurrence_blocks_copies_and_hot_document(spark, rows):
    rng = random.Random(2)
    docs = {0: [f"e{i}" for i in range(40)]}
    docs.update({d: rng.sample([f"e{i}" for i in range(40)], rng.randrange(1, 6)) for d in range(1, 60)})
    docs.update({d: ["e1", "e2", "e3"] for d in range(60, 160)})
    expected = Counter(p for items in docs.values() for p in combinations(sorted(set(items)), 2))
    bridge = spark.createDataFrame([(d, i) for d, items in docs.items() for i in items + items[:1]], "d long, i string")
    want = sorted(((a, b, n) for (a, b), n in expected.items()), key=repr)
    for block in (4, 7, 512):
        assert rows(cooccurrence(bridge, "d", "i", block), "a", "b", "n") == want
    both = {(r.a, r.b): r.n for r in symmetric(cooccurrence(bridge, "d", "i")).collect()}
    assert all(both[(b, a)] == n for (a, b), n in both.items())
