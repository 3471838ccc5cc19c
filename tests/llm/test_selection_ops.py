"""Url filter, hard negatives and importance resampling against brute force, with odd inputs."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txscreen.functions import bloom
from txscreen.llm import importance, negatives, urls
from txscreen.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_hard_negatives"])
def test_query_matches_sql(name, compare):
    assert compare(QUERIES[name], ORACLE_SQL[name]) > 0


# --- urls


def judged(url, rules, default="allow"):
    """(host, path, rule, verdict) by comparing a url with every rule."""
    rest = "" if url is None or "://" not in url else url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best and best[2] + best[3], best[4] if best else default)


ODD_URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.net/en/", "HTTP://a.Example.NET/en/x?y#z", "x://net", "x://net/", "x://net?/", "x://anet/", "x://.net/", "x://example.org/fr/#a", "x://example.org/fr", "a://b://net/x",
    "x://example.com/de/", "x://deep.er.example.com/de/x/y/z/" + "q/" * 2000, "x://" + "a." * 500 + "net/", "x://ünï.net/é", "x://net/\nline", "x://example.net//en/", "x://example.net/en", "mailto:x@net", "x://ÀB.net/",
]


def test_odd_urls_and_clashing_names(spark):
    rows = [(i, u, "mine", i % 3) for i, u in enumerate(ODD_URLS + ODD_URLS[:5])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, Verdict int")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    got = urls.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "host", "Verdict", "_host", "path", "rule", "_verdict"]
    want = {i: judged(u, urls.RULES) for i, u, _, _ in rows}
    assert {r.page_id: (r._host, r.path, r.rule, r._verdict) for r in got.collect()} == want
    assert got.where("host <> 'mine'").count() == 0
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r._verdict for r in urls.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_long_lists_give_the_same_by_broadcast_and_by_shuffle(spark):
    draw = random.Random(3)
    name = lambda: "".join(draw.choice("abc") for _ in range(draw.randint(1, 3)))
    path = lambda n: "".join(draw.choice(["/", "a", "b", "/a/", ""]) for _ in range(n))
    rules = {}
    for _ in range(600):
        rules[".".join(name() for _ in range(draw.randint(1, 4))), path(draw.randint(0, 4))] = draw.choice(["block", "allow"])
    listed = [(h, p, v) for (h, p), v in rules.items()]
    tested = [f"x://{'.'.join(name() for _ in range(draw.randint(1, 6)))}/{path(5)}?q" for _ in range(1500)] + ["x://a.b.c/a/a"] * 800
    pages = spark.createDataFrame(list(enumerate(tested)), "page_id long, url string")
    # equal rules of both kinds: block wins
    table = spark.createDataFrame([*listed, *[(h, p, "block") for h, p, _ in listed[:40]], ("zz", None, None)], "host string, path string, verdict string")
    listed = [(h, p, "block" if i < 40 else v) for i, (h, p, v) in enumerate(listed)] + [("zz", "", "block")]
    for limit in (urls.BROADCAST_BYTES, 0):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, table, limit=limit).collect()}
        assert got == {i: judged(u, listed) for i, u in enumerate(tested)}


def test_the_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    blocks = bloom.blocks_for(20_000)
    made = bloom.bloom_filter(keys, blocks, "k")
    asked = spark.range(60_000).select(F.col("id"), F.col("id").cast("string").alias("k")).withColumn("block", bloom.block_of(blocks, "k"))
    passed = asked.join(made, "block").where(bloom.may_contain("words", "k"))
    assert passed.where("id < 20000").count() == 20_000
    assert passed.where("id >= 20000").count() < 40_000 * 0.01
    # the exact join removes what the filter lets through
    one = urls.RuleList(spark.createDataFrame([(f"h{i}", "/", "block") for i in range(300)], "host string, path string, verdict string"))
    sites = spark.range(30_000).select(F.concat(F.lit("h"), F.col("id")).alias("_tail"), F.lit("/").alias("_head"))
    assert one.verdicts(sites).count() == 300 and one.possible(sites).count() < 1500


# --- hard negatives


def mined(rows, positives=5, negatives_=10, low=30, high=90, every=100):
    """rows: (id, label, vector). All rows of every anchor, pair by pair."""
    clean = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        clean.append((i, label, tuple(math.floor(256 * v) for v in x)))
    out = []
    for i, label, q in sorted(set(c for c in clean if c[0] % every == 0)):
        seen = sorted((-sum(a * b for a, b in zip(q, o, strict=True)), j, m == label) for j, m, o in clean if j != i and len(o) == len(q))
        for s, j, _ in [x for x in seen if x[2]][:positives]:
            found = [x for x in seen if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives_]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (t, n, _) in enumerate(found)]
    return sorted(out)


def hard(spark, rows, schema="vec_id long, label int, embedding array<double>", **settings):
    made = negatives.whole_vectors(spark.createDataFrame(rows, schema))
    return sorted(tuple(r) for r in negatives.hard_negatives(made, F.col("id") % 100 == 0, **settings).collect())


@pytest.mark.parametrize("root_bytes", [negatives.ROOT_BYTES, 0])
def test_hard_negatives_match_brute_force(spark, root_bytes):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(4, 6))
    rows = [(i, int(i % 4), [float(v) for v in np.round(centre[i % 4] + draw.normal(size=6) * 0.7, 1)]) for i in range(5000)]
    assert hard(spark, rows, root_bytes=root_bytes) == mined(rows)


def test_hard_negatives_with_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 3, [float(i % 7) / 4, float(i % 5) - 2]) for i in range(0, 900)]
    rows += [(i, 1, [1.0, 1.0]) for i in range(1000, 2200)]  # a large group of equal vectors
    rows += [(100, 2, [0.5, 0.5]), (300, 0, [nan, 1.0]), (301, 0, [inf, 1.0]), (302, 0, [None, 1.0]), (303, None, [1.0, 1.0]), (304, 1, None), (None, 1, [1.0, 1.0])]
    rows += [(2300, 1, []), (2301, 1, []), (2302, 0, []), (2400, 5, [1.0] * 40), (2401, 5, [1.0] * 40), (2402, 6, [0.5] * 40), (2403, 6, [-0.5] * 40), (2500, 9, [1e6, -1e6]), (2501, 9, [1e6, -1e6]), (2502, 8, [5e5, -5e5])]
    rows += [rows[3]] * 4 + [rows[100]] * 2
    assert hard(spark, rows) == mined(rows)
    assert hard(spark, rows[:1]) == [] and hard(spark, [(304, 1, None)]) == []


def test_a_tree_finds_what_a_scan_finds(monkeypatch):
    draw = np.random.default_rng(1)
    monkeypatch.setattr(negatives, "LEAF", 8)
    monkeypatch.setattr(negatives, "FAN", 3)
    x = draw.integers(-40, 40, size=(700, 4))
    ids, labels, copies = np.arange(700), draw.integers(0, 5, 700), draw.integers(1, 3, 700)
    leaves = list(negatives._pack(0, {4: [(ids, labels, copies, x)]}))
    assert sum(leaf[2] for leaf in leaves) == 700 and all(leaf[2] <= 8 for leaf in leaves)
    tree = negatives.Tree([leaf[2:] for leaf in leaves])
    for ask in range(40):
        q, label, scores = x[ask], int(labels[ask]), x @ x[ask]
        for same in (True, False):
            for low, high, kth, kth_id in ((-(10**9), 10**9, None, None), (0, 900, None, None), (-300, 200, 100, 350)):
                take = (scores >= low) & (scores <= high) & ((labels == label) == same) & (ids != ask)
                if kth is not None:
                    take &= (scores > kth) | ((scores == kth) & (ids < kth_id))
                want = [(int(scores[i]), int(i)) for i in sorted(np.flatnonzero(take), key=lambda i: (-scores[i], i)) for _ in range(copies[i])][:7]
                got = list(tree.search(ask, label, q, [(0, low, high, kth, kth_id)], 7, same))
                assert [(int(s), int(i)) for _, found, values in got for i, s in zip(found, values, strict=True)] == want


# --- importance


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def resampled(docs, target, grams=1, buckets=10_000, share=10, least=20, seed=2024):
    def runs(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for total, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            np.add.at(total, runs(x), 1)
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + buckets) / ((a + 1) * (int(t.sum()) + buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    rows = []
    for i, x in docs:
        own = runs(x)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for n, r in enumerate(able[: share * len(able) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resampling_query_matches_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, data)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == resampled(docs, target)


@pytest.mark.parametrize("grams", [1, 3])
def test_resampling_with_odd_texts(spark, grams):
    texts = [None, "", "  \x00 !!", "One", "ÄÖ ü日本 x\u00a0y", "\u0080a", "a" * 70_000, "word " * 40_000, "Mixed-CASE_text 12a" * 9, "tail\x7fsplit`here{now", "x" * 25]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, " ".join(f"w{(i * k) % 37}" for k in range(5 + i % 60))) for i in range(400)]
    docs += [(900 + i, "the same text of more than twenty words " * 3) for i in range(300)] + [(None, "w1 " * 30), (5, "w2 " * 30), (5, "w2 " * 30)]
    target = ["w1 w2 w3 the same", None, "", "w1 " * 50]
    d = spark.createDataFrame([(i, t, 1, "own") for i, t in docs], "doc_id long, text string, rank int, weight string")
    got = importance.resample(d, spark.createDataFrame([(t,) for t in target], "text string"), grams=grams, buckets=1000)
    assert sorted((tuple(r) for r in got.drop("n_words").collect()), key=repr) == resampled(docs, target, grams, 1000)
    assert importance.resample(d.limit(0), spark.createDataFrame([], "text string")).count() == 0
    kept = importance.drawn_documents(d, spark.createDataFrame([(t,) for t in target], "text string"), grams=grams, buckets=1000)
    assert kept.columns == d.columns and kept.count() == got.where("rank IS NOT NULL").count()


def test_planes_add_up():
    draw = np.random.default_rng(2)
    gain = draw.integers(-9000, 9000, 1003)
    counts = draw.integers(0, 70_000, (5, 1003)) * (draw.random((5, 1003)) < 0.2)
    assert (importance.GainPlanes(gain).sums(counts) == counts @ gain).all()
    assert (importance.GainPlanes(np.zeros(10, np.int64)).sums(np.ones((2, 10), np.int64)) == 0).all()
