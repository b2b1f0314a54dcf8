"""Lexical search, URL filter and conversation repair against brute force, on odd rows and empty tables."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusgraph.functions.scale import cut

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def _ranked(docs, items, k=20):
    own = [(i, _terms(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    df = collections.Counter(t for _, w in own for t in set(w))
    counted = [(i, len(w), collections.Counter(w)) for i, w in own if w]
    out = []
    for item, text in items:
        scores = []
        for doc, size, tf in counted:
            m = 75 + (25 * size * n) // total
            score = 0
            for t in _terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        scores.sort(key=lambda s: s[:3])
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    names = [f"{a}{b}" for a in "abcdeé" for b in "xyzÉ9"] + ["the", "of"] * 8
    docs = [(i * 7 % 401, " ".join(rng.choice(names) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    docs += [(9001, None), (9002, ""), (9003, " -- !"), (None, "ax bx the"), (None, "ax the"), docs[3], docs[3], (9004, "THE " * 5000 + "Ax"), (9005, "é\x00ax_bx")]
    items = [(str(i), " ".join(rng.choice(names) for _ in range(rng.randint(1, 12)))) for i in range(40)]
    items += [("n", None), ("e", ""), ("u", "unheard"), ("0", "ax AX ax bx"), (None, "the the")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
def test_search_equals_brute_force(spark, corpus, rows, block_bytes, shard_bytes):
    from corpusgraph.llm import lexical_search

    docs, items = corpus
    if block_bytes == 1:
        items = items[-12:]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, terms string").repartition(3)
    asked = spark.createDataFrame(items, "item_id string, text string")
    index = cut(lexical_search.build_index(frame, shard_bytes=shard_bytes))
    found = lexical_search.search(index, asked, block_bytes=block_bytes)
    assert rows(found) == _ranked(docs, items)


def test_search_of_nothing(spark):
    from corpusgraph.llm import lexical_search

    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "a")], "item_id string, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.selectExpr("doc_id", "'- -' AS text"), items)):
        found = lexical_search.search(cut(lexical_search.build_index(d)), i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_long_lists_are_skipped(spark):
    from corpusgraph.llm import lexical_search as ls

    rng = random.Random(2)
    texts = [" ".join(["the"] * rng.randint(0, 4) + ["of"] * rng.randint(0, 2) + [f"w{rng.randint(0, 50)}"] * rng.randint(1, 30)) for _ in range(4000)]
    texts[40:60] = ["rare the of"] * 20
    found = ls.postings(pa.array(texts))
    order = {bytes(t.as_py()): i for i, t in enumerate(found.terms)}
    row = [pa.scalar(found.terms.to_pylist(), pa.list_(pa.binary()))]
    packed = (found.starts, found.docs, found.tfs, np.arange(len(texts)), np.zeros(len(texts), bool), found.sizes)
    row += [pa.scalar(x.tobytes(), pa.binary()) for x in packed]
    terms = [b"the", b"of", b"rare"]
    n, total = len(texts), int(found.sizes.sum())
    weights = np.array([ls.weight(n, int(found.starts[order[t] + 1] - found.starts[order[t]])) for t in terms], np.int64)
    shard = ls.Shard(row, pa.array(terms, pa.binary()), weights, n, total)
    best = ls.Best(20)
    read = ls.run_query(shard, ls.Query(0, [0, 1, 2], [1, 1, 1]), best)
    assert sorted(best.id.tolist()) == list(range(40, 60))
    assert read < 0.2 * (len(shard.lists[0][0]) + len(shard.lists[1][0]))
    again = ls.Best(20)
    ls.run_query(shard, ls.Query(0, [0, 1, 2], [1, 1, 1]), again, doc_block=1, long_share=2.0)
    assert again.score.tolist() == best.score.tolist() and again.id.tolist() == best.id.tolist()


def _urls():
    bad = [(i, f"http://Spam.example.com/buy/{i}.html?x={i}", i % 8 != 0 if i < 40 else None) for i in range(60)]
    good = [(100 + i, f"https://spam.example.com/{('news', 'blog', 'talk')[i % 3]}/{i}/a#b", False if i < 30 else None) for i in range(60)]
    twins = [(200 + i, f"https://shop.example.com/{('pills', 'bets')[i % 2]}/{i}", True if i < 40 else None) for i in range(60)]
    odd = [(900, None, None), (901, "no scheme", True), (902, "http://", None), (903, "ftp://A.NET/x|y/*", None), (904, "http://b.net", None), (905, "http://q/" + "z/" * 500, None), (906, "http://é.org/fr/x", None)]
    return bad + good + twins + odd + [odd[3]]


def test_url_filter(spark):
    from corpusgraph.llm import url_filter
    from corpusgraph.llm.queries import URL_RULES

    frame = spark.createDataFrame([(i, u, b, "h", "n") for i, u, b in _urls()], "page_id long, url string, bad boolean, host string, node string")
    out = {r.page_id: r for r in url_filter.judge_urls(frame, URL_RULES, label="bad").collect()}
    assert len(out) == len({i for i, *_ in _urls()})
    for page, url, _ in _urls():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
        fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fit, key=lambda r: len(r.name), default=None)
        got = out[page].judged
        assert (got.host, got.path, got.rule) == (host, path, rule.name if rule else None)
        if rule:
            assert got.verdict == rule.verdict
        assert out[page].host == "h" and out[page].node == "n"
    verdicts = {i: r.judged.verdict for i, r in out.items()}
    assert all(verdicts[i] == "block" for i in range(60)) and all(verdicts[200 + i] == "block" for i in range(60))
    assert all(verdicts[100 + i] == "allow" for i in range(60)) and verdicts[901] == "allow"
    assert out[45].judged.template == "spam.example.com/buy/*"
    assert out[101].judged.template == "spam.example.com/blog|news|talk/*/a"
    assert out[201].judged.template == "shop.example.com/bets|pills/*"
    assert url_filter.judge_urls(frame.limit(0), URL_RULES).count() == 0


def test_url_purity_is_smoothed(spark):
    from corpusgraph.llm import url_filter

    rows = [(f"http://h/a/{i}", True) for i in range(20)] + [(f"http://h/b/{i}", False) for i in range(20)] + [("http://h/b/x", None)]
    out = url_filter.judge_urls(spark.createDataFrame(rows, "url string, bad boolean"), (), label="bad")
    purity = {r.judged.template: r.judged.purity for r in out.collect()}
    host = (20 + 5 * 21 / 42) / 45
    assert purity["h/a/*"] == pytest.approx((20 + 5 * (20 + 5 * host) / 25) / 25)
    assert purity["h/b/*"] == pytest.approx((0 + 5 * (0 + 5 * host) / 25) / 25)


def _best_repair(rows):
    """rows of (role, text, fault); backward, with whole strings compared."""
    @functools.cache
    def go(i, state):
        follow, name = {"": "u", "s": "u", "u": "a", "a": "u"}[state], {"u": "user", "a": "assistant"}
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                return 0, "", ()
            cost, audit, out = go(i, follow)
            return cost + 3, "I" + audit, (f"{name[follow]}:", *out)
        role, text, fault = rows[i]
        more = 3 if fault == 3 else 0
        cost, audit, out = go(i + 1, state)
        ways.append((cost + 4, "D" + audit, out))
        if fault in (0, 3):
            if role[:1] == follow or (role[:1] == "s" and state == ""):
                cost, audit, out = go(i + 1, role[:1])
                ways.append((cost + more, "K" + audit, (f"{role}:{text}", *out)))
            cost, audit, out = go(i + 1, follow)
            ways.append((cost + more + 3, "R" + audit, (f"{name[follow]}:{text}", *out)))
            for k in (1, 2):  # insertions, then this row
                ins, at = [], state
                for _ in range(k):
                    at = {"": "u", "s": "u", "u": "a", "a": "u"}[at]
                    ins.append(f"{name[at]}:")
                to = {"u": "a", "a": "u"}[at]
                cost, audit, out = go(i + 1, to)
                if role[:1] == to:
                    ways.append((cost + more + 3 * k, "I" * k + "K" + audit, (*ins, f"{role}:{text}", *out)))
                ways.append((cost + more + 3 + 3 * k, "I" * k + "R" + audit, (*ins, f"{name[to]}:{text}", *out)))
        return min(ways)

    return go(0, "")


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def _expected(rows):
    out = []
    left = _damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = text.strip("\t\n\x0b\x0c\r ")
            faults.append(1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3)
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, said = _best_repair(tuple((r[2], r[3], f) for r, f in zip(own, faults, strict=True)))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(("user", "assistant", "system", "user", "assistant", "tool", "", None, "umpire"))
            text = rng.choice(("Hi.", "Yes!", "no stop", "What? ", "", None, "é。", f"text {rng.random()}.", f"open {rng.random()}"))
            rows.append((conv, rng.choice((turn, turn, turn + 3, None)), role, text))
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None), (500, 1, "user", "x" * 20000)]
    return rows + rows[5:9]


@pytest.mark.parametrize("spill_bytes", [8, 1 << 20])
def test_repair_equals_brute_force(spark, rows, spill_bytes):
    from corpusgraph.llm import conversation_repair

    given = _conversations()
    frame = spark.createDataFrame([(*r, "x", "y") for r in given], "conv_id long, turn long, role string, text string, conv string, fault string").repartition(5)
    out = conversation_repair.repair(conversation_repair.damaged(frame), spill_bytes=spill_bytes)
    assert rows(out) == _expected(given)


def test_repair_of_dropped_empty_and_undamaged(spark, rows):
    from corpusgraph.llm import conversation_repair as cr

    schema = "conv_id string, turn int, role string, text string"
    gone = next(f"c{i}" for i in range(1000) if zlib.crc32(f"c{i}:7".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 7, "user", "a.")], schema)
    none = hashlib.sha256(b"").hexdigest()
    assert rows(cr.repair(cr.damaged(frame))) == [(gone, 0, 0, 0, 0, 0, 0, "", none)]
    whole = hashlib.sha256(b"user:a.\nassistant:").hexdigest()
    assert rows(cr.repair(cr.plain(frame))) == [(gone, 0, 0, 0, 0, 0, 3, "KI", whole)]
    assert cr.repair(cr.plain(frame.limit(0))).count() == 0


def test_giant_conversation_crosses_batches(spark, rows):
    from corpusgraph.llm import conversation_repair as cr

    frame = spark.range(3000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
    out = cr.repair(cr.plain(frame), spill_bytes=64).first()
    digest = hashlib.sha256("\n".join(f"{('user', 'assistant')[i % 2]}:t{i}." for i in range(3000)).encode()).hexdigest()
    assert (out.cost, out.audit, out.repaired_sha256) == (0, "K" * 3000, digest)
