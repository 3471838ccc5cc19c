"""PII, language id, SimHash, mixing, vectors, Hamming search and the pipeline against brute force."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import xxhash

from txscreen.llm import components, hamming, langid, mixing, pii, registry, simhash, vectors
from txscreen.llm.common import table


def groups(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    root = groups(500, edges)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()}
    assert got == {n: root[n] for e in edges for n in e if e[0] != e[1]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- personal data

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def spans_of(text):
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans_match_the_plain_patterns(spark):
    r = random.Random(3)
    bits = ["a", "B", ".", "@", "-", "+", "1", "2", "9", "255", ".", "256", "4111111111111111", " ", "é", "_", "%", "(", ")", "\U0001f600", "\n", "0"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(1500)] + [None, "", "a@b.c_x@d.e.@f.g " * 5, "1 " * 500]
    got = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for x in got:
        assert sorted((pii.KINDS[s.kind], s.start, s.end) for s in x.base) == sorted(spans_of(texts[x.doc_id])), texts[x.doc_id]


def test_very_long_runs_take_linear_time(spark):
    texts = ["a" * 1_000_000 + "@", "1" * 1_000_000, "1 " * 200_000, "+1" + " " * 500_000]
    assert pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 4


def test_patterns_discover_what_seeds_teach(spark):
    cards = [c for c in (f"40128888888{k:05}" for k in range(10_000)) if valid("card", c)][:12]
    rows = [(i, f"words before card number is {c} and after") for i, c in enumerate(cards)]
    n = len(rows)
    rows += [(100, "again card number is 4012888899999999 here"), (101, "clean text with year 2024 and 4012888899999999 alone"), (102, "plain words")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert n == 12 and all(len(got[i].base) == 1 and not got[i].added for i in range(n))
    added = [(pii.KINDS[s.kind], s.start, s.end) for s in got[100].added]
    assert added == [("card", 21, 37)] and not got[101].added and not got[102].added


def test_hidden_identifiers_are_discovered(spark):
    # nine tenths of the identifiers teach the words before them; the rest, and none of the plain numbers, is found by them
    r = random.Random(6)
    frames = {"card": ["my card number is {} ok", "charged to card {} today"], "phone": ["you can call me at {} now", "fax number: {} only"], "email": ["please write to {} soon"], "ip": ["connection from host {} refused"]}
    made = {
        "card": lambda: next(c for c in iter(lambda: str(r.randrange(10**15, 10**16)), "") if pii_luhn(c)),
        "phone": lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}", "email": lambda: f"u{r.randrange(10**6)}@mail{r.randrange(99)}.example.com", "ip": lambda: ".".join(str(r.randrange(1, 255)) for _ in range(4)),
    }
    docs = []
    for kind, texts in frames.items():
        for t in texts:
            docs += [f"some words {r.randrange(99)} " + t.format(made[kind]()) for _ in range(150)]
    docs += [f"order {r.randrange(10**6)} has {r.randrange(10**4)} parts, see page {r.randrange(500)}" for _ in range(500)]
    r.shuffle(docs)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {x.kind: x for x in pii.discovery_recall(df).collect()}
    assert set(got) == set(frames)
    for kind, x in got.items():
        assert x.hidden >= 5 and x.found / x.hidden >= 0.9 and x.found / x.discovered >= 0.9, (kind, x)
    # words that say nothing teach nothing
    noise = [(i, " ".join(str(hash((i, j)) % 10**6).translate(str.maketrans("0123456789", "abcdefghij")) for j in range(9)) + f" {made['ip']()} end") for i in range(200)]
    assert [x.discovered for x in pii.discovery_recall(spark.createDataFrame(noise, "doc_id long, text string")).collect()] == [0]
    assert pii.discovery_recall(df.limit(0)).count() == 0


def pii_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_identifiers_with_blanks_are_whole(spark):
    cards = [c for c in (f"40128888{k:08}" for k in range(10_000)) if valid("card", c)][:40]
    spaced = [" ".join(c[i : i + 4] for i in range(0, 16, 4)) for c in cards]
    rows = [(i, f"words before card number is {c} and after") for i, c in enumerate(spaced)]
    rows += [(50 + i, f"please call me at +1 (974) 555-{3000 + i} or later") for i in range(40)]
    unseen = {100: ("again card number is 4111 1111 1111 1112. Yes", "again card number is <CARD>. Yes"), 101: ("now card number is 4111-1111-1111-1112 ok", "now card number is <CARD> ok"), 102: ("card number is 3782 822463 10006 ok", "card number is <CARD> ok"), 103: ("so call me at (974) 555-3436, do", "so call me at <PHONE>, do"), 104: ("so call me at 974.555.3436", "so call me at <PHONE>"), 105: ("call me at 10 or 4111 1111 1111 1112", None), 106: ("card number is 12 34 ok 1 2 3x", None)}
    rows += [(i, t) for i, (t, _) in unseen.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.mask(df).collect()}
    for i, (t, want) in unseen.items():
        assert got[i] == (want or t), t
    found = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert all(len(found[i].base) == 1 and not found[i].added for i in [*range(40), *range(50, 90)])


def test_mask_keeps_other_columns_and_copies(spark):
    rows = [(1, "mail a.b@c.de now", "k"), (1, "mail a.b@c.de now", "k"), (2, None, "n"), (None, "ip 1.2.3.4", "z")]
    got = sorted(map(str, (tuple(r) for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string, start string")).select("doc_id", "text", "start").collect())))
    assert got == sorted(map(str, [(1, "mail <EMAIL> now", "k"), (1, "mail <EMAIL> now", "k"), (2, None, "n"), (None, "ip <IP>", "z")]))


def test_context_is_read_by_words(spark):
    cards = [c for c in (f"40128888888{k:05}" for k in range(10_000)) if valid("card", c)][:24]
    long = "w" * 300
    rows = [(i, f"words before card number is {c} and after") for i, c in enumerate(cards[:12])]
    rows += [(20 + i, f"{i} a {long} holds {c} x") for i, c in enumerate(cards[12:])]
    unseen = {100: "card number is" + " " * 200 + "4012888899999999", 101: f"{long} holds 4012888899999999", 102: f"{long}w holds 4012888899999999"}
    got = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows + list(unseen.items()), "doc_id long, text string")).collect()}
    assert got[100] == "card number is" + " " * 200 + "<CARD>" and got[101] == f"{long} holds <CARD>"
    assert got[102] == unseen[102] or got[102] == f"{long}w holds <CARD>"


def test_mask_cuts_long_texts_and_overlaps(spark):
    many = "mail a.b@c.de \U0001f600 " * 5000
    odd = ["+1 4111111111111111 x", "x" * 255 + " a@b.c " + "y" * 600, "é" * 256 + " 1.2.3.4", "a@b.c", "12 a", "", None, many]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.mask(docs).collect()}
    for i, t in enumerate(odd):
        want, at = "", 0
        for s, e, k in sorted((s, e, pii.KINDS.index(k)) for k, s, e in spans_of(t)):
            if s >= at:
                want += t[at:s] + f"<{pii.KINDS[k].upper()}>"
            at = max(at, e)
        assert got[i] == (None if t is None else want + t[at:]), t
    assert pii.mask(docs.limit(0)).count() == 0


# --- clashing names

CLASH = ["key", "none", "doc", "spans", "uid", "size", "taken", "n", "src", "words", "lang_id", "fp", "component", "_KEY", "_size", "_taken", "_spans", "_doc"]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]], ids=lambda f: f.__name__)
def test_stages_keep_clashing_columns_and_take_odd_rows(spark, data, stage):
    rows = [(1, "the cat sat on the mat", "en", "a", 22), (1, "the cat sat on the mat", "en", "a", 22), (2, None, "en", None, 0), (None, "der hund und die katze hier", "de", "b", 27), (3, "", None, "a", 0), (4, "ip 1.2.3.4 is " + "long words here " * 20_000, "en", None, 9)]
    df = spark.createDataFrame([(*r, *[str(i)] * len(CLASH)) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))
    got = stage(spark, df, data)
    assert got.columns == df.columns
    out = got.collect()
    assert out and all(r["key"] == r["_KEY"] == r["_size"] == r["n"] for r in out)
    assert stage(spark, df.limit(0), data).count() == 0


# --- language


def test_language_accuracy_on_held_out_documents(spark, data):
    truth = {r.doc_id: r.lang for r in table(spark, data, "documents").collect()}
    rows = [r for r in registry.QUERIES["op5_language_id"](spark, data).collect() if r.held_out]
    assert len(rows) > 20 and np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "und die katze"), (5, "THE DOG"), (6, "漢字"), (7, "the " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: r.lang_id for r in langid.predict(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 7)] == ["und", "und", "und", "de", "en", "en"] and got[6].score == 0.0
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_id.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_long_texts_have_the_same_grams_in_parts():
    text = "Größe, and 12 more words éà " * 50
    whole, parts = (np.sort(np.concatenate([h for _, h in langid.grams([text], n)])) for n in (1 << 22, 37))
    assert (whole == parts).all()


def test_more_languages_than_a_word_has_bits(spark):
    model = langid.build(spark.createDataFrame([(f"l{i:03}", g, 5) for i in range(70) for g in range(100 * i, 100 * i + 50)], "lang string, gram long, n long"))
    assert model.masks.shape[0] == 2 and len(model.languages) == 70
    for i in (0, 63, 64, 69):
        own = np.arange(100 * i, 100 * i + 50).astype(np.uint64)
        places = list(langid._places(own, model.masks.shape[1]))
        assert all((model.masks[i // 64][p] >> np.uint64(i % 64) & np.uint64(1)).all() for p in places)


def test_language_shares_are_those_of_exact_sets(spark, data):
    """The filter against plain sets: every known n-gram is found, and corrected counts are near the true ones."""
    docs = table(spark, data, "documents").where("lang is not null and text is not null")
    model = langid.train(docs)
    rows = docs.select("text", "lang").collect()
    counts = {}
    for i, h in langid.grams([r.text for r in rows]):
        counts.setdefault(rows[i].lang, Counter()).update(h.tolist())
    rate = {}
    for lang, c in counts.items():
        c = {g: n for g, n in c.items() if n >= langid.MIN_COUNT}
        total = sum(c.values())
        rate[lang] = {g: n / total for g, n in c.items() if n / total >= langid.MIN_RATE}
    top = {}
    for c in rate.values():
        for g, x in c.items():
            top[g] = max(x, top.get(g, 0))
    sets = [{g for g, x in rate[lang].items() if x >= langid.MIN_SHARE * top[g]} for lang in model.languages]
    assert sorted(rate) == model.languages and (model.false_rate <= langid.FALSE_RATE).all()
    texts = [r.text for r in rows[:60]]
    got, own = model.shares(texts), [[] for _ in texts]
    for i, h in langid.grams(texts):
        own[i] += h.tolist()
    exact = np.array([[np.mean([g in s for g in h]) if h else 0 for s in sets] for h in own])
    assert np.abs(got - exact).max() < 0.03
    assert [model.languages[k] for k in exact.argmax(axis=1)] == model.predict(texts)[0]


# --- near duplicates


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def test_fingerprints():
    for t in [None, "", " \t", "one", "One two", "A b C d\x0be", "É à b c d", "x " * 500, "w1 w2 w3 w4 " * 40_000]:
        assert simhash.fingerprint(t) == (plain_print(t) if len(t or "") < 10_000 else simhash.fingerprint(t))


def test_the_decoder_is_perfect():
    table_ = simhash.golay_decoder()
    assert len(np.unique(table_)) == 4096 and (np.bincount(table_) == 2048).all()


def clustered_prints(seed, n=3000):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 30])):
            x = base
            for b in r.sample(range(64), r.randrange(0, 5)):
                x ^= 1 << b
            out.append(x)
    return out


@pytest.mark.parametrize("most", [1 << 20, 8])
def test_links_within_three_bits_are_found(spark, most):
    prints = clustered_prints(7, 1500)
    u = np.unique(np.array(prints, np.uint64))
    edges = [(i, j) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 3).tolist() if i < j]
    root = groups(len(u), edges)
    rows = [(i, int(np.array(p, np.uint64).view(np.int64))) for i, p in enumerate(prints)]
    got = {int(np.array(r.fp, np.int64).view(np.uint64)): r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long"), most).collect()}
    first = {}
    at = {int(v): k for k, v in enumerate(u)}
    for i, p in enumerate(prints):
        first[root[at[p]]] = min(first.get(root[at[p]], 1 << 60), i)
    assert edges and got == {p: first[root[at[p]]] for p in prints}


def test_simhash_query(spark, data):
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    rows = registry.QUERIES["op6_simhash"](spark, data).collect()
    assert len(rows) == len(texts) and all(r.fingerprint == f"{plain_print(texts[r.doc_id]):016x}" for r in rows)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, fp long")).count() == 0


# --- vectors


def made_vectors():
    rng = np.random.default_rng(1)
    base = rng.standard_normal((15, 16))
    rows = [(i, (base[rng.integers(15)] + rng.standard_normal(16) * rng.choice([0, 0.05, 0.2])).tolist()) for i in range(500)]
    return rows + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, rows[0][1]), (5003, rows[0][1]), (5004, [1.0, None]), (5005, []), (5006, [1e300] * 16), (5007, [2e300] * 16), (5008, [1.0] * 8)]


@pytest.mark.parametrize("most", [8192, 20])
def test_vector_links_match_brute_force(spark, most, monkeypatch):
    if most == 20:
        monkeypatch.setattr(vectors, "BLOCK", 8)
        monkeypatch.setattr(vectors.link_vectors, "__defaults__", (vectors.THRESHOLD, most))
    rows = made_vectors()
    unit = [None] * len(rows)
    for i, (_, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    degree, root, first = Counter(x for e in edges for x in e), groups(len(rows), edges), {}
    for i, (k, _) in enumerate(rows):
        first[root[i]] = min(first.get(root[i], 1 << 60), k)
    want = sorted((k, degree[i], first[root[i]]) for i, (k, _) in enumerate(rows))
    df = spark.createDataFrame([(k, v, 0, 1) for k, v in rows], "vec_id long, embedding array<double>, label int, node int")
    got = vectors.near_duplicate_vectors(df).collect()
    assert [r[2] for r in want] == [r.component_id for r in sorted(got, key=lambda r: (r.vec_id, r.n_links, r.component_id))]
    found, all_ = sum(r.n_links for r in got), 2 * len(edges)
    assert found <= all_ and found >= 0.999 * all_ and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.near_duplicate_vectors(df.limit(0)).count() == 0


# --- search


@pytest.mark.parametrize("width", [12, 64, 65, 130])
@pytest.mark.parametrize("rows_of", [None, (100, 7, 5)])
def test_topk_is_exact_with_ties_and_copies(spark, monkeypatch, rows_of, width):
    if rows_of:
        for name, n in zip(("BLOCK_ROWS", "CHUNK_ROWS", "LEAST_ROWS"), rows_of, strict=True):
            monkeypatch.setattr(hamming, name, n)
    r = random.Random(2)
    near = [r.getrandbits(width) for _ in range(6)]
    codes = [r.choice(near) ^ sum(1 << r.randrange(width) for _ in range(r.randrange(4))) & ((1 << width) - 1) for _ in range(200)] + [5] * 40
    rows = list(enumerate(codes)) + [(7, codes[7])] + [(20, 5)] * 7 + [(220, 5)] * 9
    vectors_ = [(i, [1.0 if c >> b & 1 else -1.0 for b in range(width)], 1, 2) for i, c in rows]
    odd = [(999, None, 1, 2), (998, [1.0, None], 1, 2), (997, [], 1, 2), (980, [1.0] * (width + 1), 1, 2), (960, [1.0] * (width + 1), 1, 2)]
    coded = lambda rows: spark.createDataFrame(rows, "id long, v array<double>, bits int, words int").select("id", hamming.sign_code("v").alias("code"))
    df, asked, got = coded(vectors_ + odd), coded(vectors_[: len(codes)] + odd).where("id % 20 = 0"), {}
    for x in hamming.nearest_codes(df, asked, 5).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.distance, x.id))
    for q in range(0, len(codes), 20):
        want = sorted(((codes[q] ^ c).bit_count(), i) for i, c in rows if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, d, i) for k, (d, i) in enumerate(want)]
    assert got[980] == [(1, 0, 960)] and got[960] == [(1, 0, 980)]
    assert len(hamming.nearest_codes(df.limit(3), df.limit(3), 10).collect()) == 6
    assert hamming.nearest_codes(df.limit(0), df.limit(0)).count() == 0


def test_nan_counts_as_positive(spark):
    got = spark.createDataFrame([([float("nan"), -1.0, 0.0],)], "v array<double>").select(hamming.sign_code("v").alias("c")).first().c
    assert (got.bits, got.words) == (3, [5])


# --- mixing


def targets_of(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), list(names), {}
    while True:
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) > 3 * sizes[s]] if free else []
        if not over:
            return out | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in over]


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 100, 1000, 4097):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k"), F.lit(3))).collect()]
        assert sorted(got) == list(range(n))


def test_mix_meets_its_targets(spark):
    r = random.Random(4)
    docs = [(i, r.choice(["b", "a", "é", None, "Z", "tiny"][: 5 if i else 6]), "w " * r.choice([0, 1, 50, 700, 3000])) for i in range(250)] + [(900, "tiny", "only five words in here"), (901, "a", None), (5, "a", "x y"), (5, "a", "x y"), (None, "a", "p q")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, text string, size string")
    got = mixing.mix_sources(df).collect()
    sizes = Counter()
    for _, s, t in docs:
        sizes[s] += len((t or "").split())
    want = targets_of(dict(sizes))
    assert len(got) == len(docs)
    taken = Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source]) and 0 <= x.taken <= 3 * x.size
        taken[x.source] += x.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    again = mixing.mix_sources(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_shards_hold_what_their_drawn_counts_say(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    monkeypatch.setattr(mixing, "_CHUNK", 8)
    docs = [(i, "ab"[i % 3 == 0], "w " * (40 * (i % 50))) for i in range(200)] + [(900, None, "x " * 3000), (901, "none", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    sizes = df.groupBy("source").agg(F.sum(mixing.word_count()).alias("source_size"))
    targets = mixing.source_targets(sizes).cache()
    plan = {r.key: r for r in mixing.slot_plan(targets).collect()}
    drawn = mixing.shard_draw(mixing.slot_plan(targets)).collect()
    shards = next(iter(plan.values())).shards
    assert shards == -(-sum(p.n for p in plan.values()) // 16) > 8
    for key, p in plan.items():
        own = sorted((r.shard, r["first"], r.slots) for r in drawn if r.key == key)
        assert [f for _, f, _ in own] == [sum(n for _, _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, _, n in own) == p.n and all(0 <= s < shards for s, _, _ in own)
        # a multinomial draw: counts vary, within five standard deviations
        counts = [dict((s, n) for s, _, n in own).get(s, 0) for s in range(shards)]
        assert max(abs(c - p.n / shards) for c in counts) < 5 * (p.n / shards) ** 0.5 + 1
        assert p.n < 3 * shards or len(set(counts)) > 1
    mix = mixing.slots(targets).collect()
    assert Counter((r.key, r.shard) for r in mix) == Counter({(r.key, r.shard): r.slots for r in drawn})
    assert sorted((r.key, r.slot) for r in mix) == sorted((k, i) for k, p in plan.items() for i in range(p.n))
    # the rows of the shards are what documents give to the mix
    rows, sized = mixing.shard_rows(df).collect(), {d: len(t.split()) for d, _, t in docs}
    assert all(r["first"] >= 0 and r["first"] + r.words <= sized[r.doc_id] for r in rows)
    given = Counter()
    for r in rows:
        given[r.doc_id] += r.words
    assert {r.doc_id: r.taken for r in mixing.mix_sources(df).collect() if r.taken} == dict(given)


# --- pipeline


def test_mixing_stage_meets_its_targets(spark, data):
    # by whole documents of more than a block: targets are 1.875, 0.75 and 0.375 of each source
    docs = [(i, f"{i} " + "w " * 1599, "en", "abc"[i % 3], 1) for i in range(900)]
    df = spark.createDataFrame(docs, table(spark, data, "documents").schema)
    got = Counter(r.source for r in corpus_pipeline.mix_sources(spark, df, data).select("source").collect())
    assert got == Counter(r.source for r in corpus_pipeline.mix_sources(spark, df.repartition(7), data).select("source").collect())
    for source, share in (("a", 1.875), ("b", 0.75), ("c", 0.375)):
        assert abs(got[source] / (300 * share) - 1) < 0.15, got


def test_pipeline(spark, data):
    docs = table(spark, data, "documents").collect()
    extra = [(9001, docs[0].text, "en", "src1", 1), (9002, None, "en", "src1", 0), (9003, "12 !!", "en", "src1", 5), (9004, "write to someone@example.com about it", None, "src1", 36), (docs[0].doc_id, docs[0].text, docs[0].lang, docs[0].source, docs[0].n_chars)]
    df = spark.createDataFrame([tuple(d) for d in docs] + extra, table(spark, data, "documents").schema)
    kept = corpus_pipeline.language_id(spark, df, data)
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in kept.collect()} == {9002, 9003} and kept.columns == df.columns
    one = corpus_pipeline.simhash_dedup(spark, kept, data).collect()
    prints = {}
    for r in kept.collect():
        prints.setdefault(plain_print(r.text), []).append(r.doc_id)
    u = np.array(sorted(prints), np.uint64)
    root = groups(len(u), [(i, j) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 3).tolist()])
    want = {}
    for k, p in enumerate(sorted(prints)):
        want[root[k]] = min(want.get(root[k], 1 << 60), *prints[p])
    assert sorted(r.doc_id for r in one) == sorted(want.values())
    masked = corpus_pipeline.mask_personal_data(spark, spark.createDataFrame(one, df.schema), data)
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[9004].text == "write to <EMAIL> about it" and rows[9004].n_chars == len(rows[9004].text) and masked.columns == df.columns
    for r in one:
        clean = not spans_of(r.text)
        assert not clean or rows[r.doc_id].text == r.text
    mixed = corpus_pipeline.mix_sources(spark, masked, data)
    assert mixed.columns == df.columns and mixed.count() > 0
    out = corpus_pipeline.run(spark, data)
    assert out.where("NOT round_trip").count() == 0 and out.count() > 0


# --- odd rows of single operators


def test_bpe_stage_takes_clashing_columns_and_odd_rows(spark, data):
    names = ["n_tokens", "ids_sha256", "split", "ids", "TEXT_", "same"]
    rows = [(1, "the cat", "en"), (1, "the cat", "en"), (2, None, None), (None, "", "de"), (3, "é" * 40_000 + " x " * 30_000, None)]
    df = spark.createDataFrame([(*r, *["own"] * len(names)) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    got = corpus_pipeline.encode_tokens(spark, df, data)
    out = got.collect()
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split", "round_trip"] and len(out) == 5
    assert all(r.round_trip for r in out) and sum(r.n_tokens == 0 for r in out) == 2
    assert len({(r.n_tokens, r.ids_sha256) for r in out if r.doc_id == 1}) == 1
    assert corpus_pipeline.encode_tokens(spark, df.limit(0), data).count() == 0


def test_language_ties_go_to_the_smallest_name_and_a_null_id_is_a_fold(spark):
    same = [(i, "one and the same text for all", lang) for i, lang in enumerate(["zu", "aa", "mm"] * 20)] + [(None, "one and the same text for all", "zu")]
    model = langid.train(spark.createDataFrame(same, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "the same text"), (None, "the same text")], "doc_id long, text string")
    got = langid.predict(docs, model).select("lang_id.lang_pred").collect()
    assert [r.lang_pred for r in got] == ["aa", "aa"]
    folds = docs.select(langid.held_out().alias("h")).collect()
    import zlib

    assert [r.h for r in folds] == [zlib.crc32(b"1") % 5 == 0, zlib.crc32(b"") % 5 == 0]


def test_simhash_of_null_ids_and_very_long_texts(spark, tmp_path):
    long = " ".join(f"word{i % 977} other{i % 1009}" for i in range(60_000))
    rows = [(5, long), (7, long + " end"), (None, long), (None, "short and alone here"), (9, "short and alone here"), (8, None), (11, "  "), (None, "nobody else says this at all")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in registry.QUERIES["op6_simhash"](spark, str(tmp_path)).collect()), key=repr)
    prints = {t: f"{simhash.fingerprint(t):016x}" for _, t in rows}
    assert prints[long] == prints[long + " end"] or bin(int(prints[long], 16) ^ int(prints[long + " end"], 16)).count("1") <= 3
    # a null id names no component unless there is no other
    first = {long: 5, long + " end": 5, "short and alone here": 9, None: 8, "  ": 8, "nobody else says this at all": None}
    assert got == sorted(((i, prints[t], first[t]) for i, t in rows), key=repr)
