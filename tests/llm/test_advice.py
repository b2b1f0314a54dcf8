"""Jobs that were once done in part: each test failed before its change."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


TONGUES = {"aa": ["the", "ing", "er", "an", "tion", "st"], "bb": ["ung", "ver", "sch", "ein", "ä", "keit"], "cc": ["que", "os", "ado", "ción", "ez", "la"]}


def test_pipeline_drops_garbled_and_foreign_texts(spark):
    import corpus_pipeline

    rng = random.Random(5)
    rows = [(i, _prose(rng, TONGUES[lang], rng.choice((12, 60, 300))), lang, "own", 0) for i, lang in enumerate(sorted(TONGUES) * 200)]
    for k in range(20):
        rows.append((1000 + 4 * k, "a" + bytes(rng.randrange(33, 127) for _ in range(1500)).decode(), None, "garbled", 0))
        rows.append((1001 + 4 * k, "a" + bytes(rng.randrange(256) for _ in range(1500)).decode("latin1"), None, "garbled", 0))
        rows.append((1002 + 4 * k, _prose(rng, ["kk", "wy", "szcz", "ło", "ji", "mu", "zb"], 300), None, "foreign", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.source: r["count"] for r in corpus_pipeline.identify_language(spark, docs, "").groupBy("source").count().collect()}
    assert kept == {"own": 600}


def test_familiarity_by_hand():
    import numpy as np
    import pyarrow as pa

    from corpusgraph.llm import familiarity

    texts = ["Ab", None, "1 2", "a", "ÄÖ ab"]
    place, last = familiarity.places(pa.array(texts))
    assert last.tolist() == [2, 2, 2, 3, 9]
    assert place[:2].tolist() == place[-2:].tolist()
    bits = np.zeros((2, familiarity.PLACES), np.float32)
    bits[1, place[:2]] = 3
    best, letters = familiarity.judge(familiarity.Familiar(bits, np.full(65, -np.inf)), pa.array(texts))
    assert letters.tolist() == [2, 0, 0, 1, 6] and best[[0, 3, 4]].tolist() == [3, 0, 1] and np.isnan(best[[1, 2]]).all()


def test_pii_keys_in_any_case():
    from corpusgraph.llm import pii

    rng = random.Random(6)
    odd = {"s": "sSſ", "k": "kKK", "i": "iIİı"}
    for key in ["apiKey", "ApiKey", "API_Key", "Api_Key", "PassWord", "passWD", "SeCret", "tOKen"]:
        assert [s[:3] for s in pii.find(f"{key}=abc12345x")] == [("secret", len(key) + 1, len(key) + 10)], key
        assert pii.mask(f"{key}: abc12345x", pii.find(f"{key}: abc12345x")) == f"{key}: [SECRET]"
    for _ in range(3000):
        key = "".join(rng.choice(odd.get(c, c + c.upper())) for c in rng.choice(["password", "passwd", "secret", "token", "api_key", "apikey", "apiky"]))
        text = f"{rng.choice(['', 'a ', 'ß '])}{key}{rng.choice(['=', ': ', ' '])}{rng.choice(['abc12345x', 'abcdefghij'])}"
        want = [("secret", *m.span(1)) for m in pii._ASSIGNED.finditer(text) if any(map(str.isdigit, m[1]))]
        assert [s[:3] for s in pii.find(text)] == want, text


def test_language_learns_from_whole_texts(spark):
    from corpusgraph.llm import language_id

    rng = random.Random(7)
    rows = [(i, "1 2 3 " * 900 + _prose(rng, TONGUES[lang], 900), lang, "s", 0) for i, lang in enumerate(["aa", "bb"] * 30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    net = language_id.learn(docs)
    assert net is not None and net.langs == ("aa", "bb")
    plain = spark.createDataFrame([(i, _prose(rng, TONGUES[lang], 60), lang, "s", 0) for i, lang in enumerate(["aa", "bb"] * 10)], SCHEMA)
    assert language_id.identify(plain, net).filter("language.lang_pred <> lang").count() == 0
    text = bytes(rng.randrange(256) for _ in range(9000))
    assert max(text.find(p) for p in language_id.pieces(text, -5)) > 6000
    assert set(language_id.pieces(b"short", 9)) == {b"short"}


def test_language_sample_is_exact_and_counts_copies_once(spark, monkeypatch):
    from corpusgraph.llm import language_id

    # Copies of the texts with the smallest keys, as many as there is room for.
    texts = spark.createDataFrame([(f"aa word {k}",) for k in range(400)], "text string").orderBy(F.xxhash64("text"))
    texts = [r.text for r in texts.collect()]
    rows = [(0, t, "aa", "s", 0) for t in [*texts, *texts[:2] * 300]] + [(0, f"bb word {k}", "bb", "s", 0) for k in range(60)]
    seen = {}

    def train(texts, targets):
        for t, lang in zip(texts, targets, strict=True):
            seen.setdefault(lang, set()).add(bytes(t) if isinstance(t, bytes) else t.encode())

    monkeypatch.setattr(language_id, "train", train)
    language_id.learn(spark.createDataFrame(rows, SCHEMA), sample=40)
    assert {lang: len(own) for lang, own in seen.items()} == {"aa": 20, "bb": 20}


def test_near_copies_without_an_id_and_ids_of_two_texts(spark):
    import corpus_pipeline
    from corpusgraph.llm import ngram_join

    def text(name, first, last):
        return " ".join([f"{name}{k}" for k in range(first, last)])

    # 1 and 2 hang together only through a text without an id; 5 is a near copy of 4 and another, clean text.
    rows = [(1, text("a", 0, 100)), (None, text("a", 8, 108)), (2, text("a", 16, 116)), (4, text("b", 0, 100)), (5, text("b", 2, 102)), (5, text("c", 0, 100)), (5, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    found = sorted(((r.doc_id or 0, r.component_id or 0) for r in ngram_join.jaccard_components(docs).collect()))
    assert found == [(0, 1), (1, 1), (2, 1), (4, 4), (5, 4), (5, 5), (5, 5)]
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {rows[0], rows[1], rows[3], rows[5], rows[6]}
