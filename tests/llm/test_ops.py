"""Small tests of the dealt operators: brute force, round trips, and the defined results of odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import chat, common, ctw, decontam, exact_dedup, ngram_join, packing, sharding, toxicity, url_filters, warc

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, n_words string"


def docs_of(spark, texts, ids=None, sources=None):
    """With extra columns of clashing names."""
    rows = [(i if ids is None else ids[i], t, None, None if sources is None else sources[i], None, "k", "s", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", "   ", "\n\t ", "a", "A", "a b c d e", "x" * 200_000, "word " * 40_000, "É é ü", "a  b c d e", "😀 b", None, "one two three four five six seven eight nine ten"]
ODD[11] = "\U0001f600 b"


def low(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def space_words(t):
    return re.findall("[^\x20\x09-\x0d]+", low(t))


# ---------------------------------------------------------------- bytes


def test_word_hashes_tell_words_apart():
    texts = [b"The the tHE then", b"", b" a\tb\x0bc ", b"x"]
    buf, _ = common.join_bytes(texts)
    a, b = common.space_words(buf)
    words = [bytes(buf[i:j]).lower() for i, j in zip(a, b, strict=True)]
    h = common.word_hashes(buf, a, b).tolist()
    assert words == [b"the", b"the", b"the", b"then", b"a", b"b", b"c", b"x"]
    assert len(set(h)) == len(set(words)) and len(set(h[:3])) == 1


# ---------------------------------------------------------------- 1: URLs


def glob_to_regex(g):
    out, i = "", 0
    while i < len(g):
        if g.startswith("**", i):
            out, i = out + ".*", i + 2
        elif g[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif g[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(g[i]), i + 1
    return re.compile(out, re.S)


def test_shift_and_matches_like_regexes():
    r = random.Random(3)
    globs = ["*.net/**", "a*b?c", "**", "*", "", "?", "x**y*z", "*.example.com/de/**", "no/such"] + ["".join(r.choice("ab/*?.") for _ in range(9)) for _ in range(40)]
    urls = ["", "a", "/", ".net/", ".a.net/x/y", "é/ü", "x/y/z"] + ["".join(r.choice("ab/.net") for _ in range(r.randrange(90))) for _ in range(300)]
    got = url_filters.ShiftAnd(globs).match(urls)
    for j, g in enumerate(globs):
        p = glob_to_regex(g)
        assert [bool(p.fullmatch(u)) for u in urls] == got[:, j].tolist(), g


def test_url_rules(spark):
    urls = ["https://a.example.net/en/1", "http://EXAMPLE.net/de?x", "https://x.example.com/de/", "ftp://b.org/fr/#x", "http://net", "http://notnet/x", None, "no scheme", "http://m.casino-win.example.com/en/", "http://casino.example.net/en/", "http://x.com/y.net/z", "http://" + "a" * 5000 + ".net/"]
    rows = url_filters.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    got = [(r.host[:20], r.path, r.rule, r.verdict) for r in rows]
    assert got[:4] == [("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/de", "net/", "block"), ("x.example.com", "/de/", "example.com/de/", "block"), ("b.org", "/fr/", "org/fr/", "allow")]
    assert got[4:8] == [("net", "", None, "allow"), ("notnet", "/x", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow")]
    assert [g[2:] for g in got[8:]] == [(None, "block"), ("example.net/en/", "allow"), (None, "allow"), ("net/", "block")]
    assert url_filters.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# ---------------------------------------------------------------- 2: toxicity


def test_segments_are_maximal():
    r = random.Random(5)
    for _ in range(200):
        x = [r.choice([-3, -1, -0.5, 1, 2, 4]) + r.random() / 7 for _ in range(r.randrange(1, 18))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(list(enumerate(x)), 0.5)]
        assert got == brute_segments(x), x


def brute_segments(x):
    """The best run, then the best on either side of it, and so on."""

    def find(lo, hi):
        best = max(((sum(x[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        *_, a, b = best
        return [*find(lo, a), (a, b - 1, round(best[0], 6)), *find(b, hi)]

    return find(0, len(x))


def test_toxicity_against_brute_force(spark):
    """Weights, calibration, passages and scores of a small table, each computed again the long way."""
    r = random.Random(37)
    good, bad = [f"{a}{b}x" for a in "abcdefgh" for b in "mnopq"], ["zzidiotic", "zzidiots", "vile", "scum"]
    texts = [" ".join([r.choice(good) for _ in range(r.randrange(5, 60))] + [r.choice(bad) for _ in range(5 if i % 4 == 0 else 0)] + [r.choice(good) for _ in range(9)]) for i in range(400)]
    toxic = [int(i % 4 == 0) for i in range(400)]
    fold = [zlib.crc32(str(i).encode()) % 5 for i in range(400)]
    params = toxicity.Params()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    m = toxicity.train(docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"))

    n = Counter(), Counter()
    for t, y, f in zip(texts, toxic, fold, strict=True):
        if f in (1, 2, 3):
            n[y].update(set(t.split()))
    vocabulary = {*n[0], *n[1]}
    owns = {w + "$": [w] for w in vocabulary}
    for w in vocabulary:
        for k in range(4, min(8, len(w)) + 1):
            owns.setdefault(w[:k], []).append(w)
    scored = {}
    for f, ws in owns.items():
        n1, n0 = (sum(c[w] for w in ws) for c in (n[1], n[0]))
        if n1 + n0 >= params.min_support and len(ws) < len(vocabulary):
            a, b = (x + params.prior * len(ws) for x in (n1, n0))
            rest = [sum(c.values()) + params.prior * len(vocabulary) for c in (n[1], n[0])]
            delta = math.log(a / (rest[0] - a)) - math.log(b / (rest[1] - b))
            scored[f] = delta, delta / math.sqrt(1 / a + 1 / b)
    want = {f: w for f, (w, z) in scored.items() if abs(z) >= params.z_min and (f.endswith("$") or abs(w) >= params.prefix_min)}
    # Neutral words under a kept prefix.
    want |= {f: 0.0 for f, (w, _) in scored.items() if f.endswith("$") and f not in want and w <= 1 and any(f[:-1].startswith(p) for p in want if not p.endswith("$"))}
    assert m.weights.keys() == want.keys() and all(m.weights[f] == pytest.approx(w) for f, w in want.items()) and "zzid" in want

    def weights(t):
        out, seen = [], []
        for i, w in enumerate(t.split()):
            x = next((want[f] for f in [w + "$", *(w[:k] for k in range(8, 3, -1) if len(w) >= k)] if f in want), 0.0)
            if x > 0:
                x /= 1 + sum(v == w and i - j < params.window for j, v in seen)
                seen.append((i, w))
            out.append(x - params.cost)
        return out

    quiet = [weights(t) for t, y, f in zip(texts, toxic, fold, strict=True) if f == 4 and not y]
    tokens = sum(map(len, quiet))
    assert m.k == pytest.approx((sum(len(brute_segments(x)) for x in quiet) + 1) / (tokens + 1000))
    seen = Counter(round(x, 1) for q in quiet for x in q)
    total = (sum(c * math.exp(x * m.lam) for x, c in seen.items()) + math.exp(-params.cost * m.lam) + math.exp(5 * m.lam)) / (tokens + 2)
    assert total == pytest.approx(1, abs=1e-6) or (m.lam == 2.0 and total <= 1)
    scores = {x.doc_id: x.t for x in docs.select("doc_id", toxicity.annotate(docs, m).alias("t")).collect()}
    for i, t in enumerate(texts):
        found = [(a, b, s, m.k * len(t.split()) * math.exp(-m.lam * s)) for a, b, s in brute_segments(weights(t))]
        found = [x for x in found if x[3] <= params.e_max]
        at = [x.span() for x in re.finditer(r"\S+", t)]
        assert [(p.start, p.end) for p in scores[i].passages] == [(at[a][0], at[b][1]) for a, b, *_ in found]
        x = math.log1p(sum(-math.log(e) for *_, e in found)), math.log1p(len(found))
        assert scores[i].score == pytest.approx(1 / (1 + math.exp(-(m.curve[0] + m.curve[1] * x[0] + m.curve[2] * x[1]))), abs=1e-4)
        assert (scores[i].score >= 0.5) == bool(toxic[i])


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    hit = Counter((r.toxic, r.predicted) for r in rows)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.85 and hit[0, 1] / (hit[0, 0] + hit[0, 1]) < 0.01


def test_toxicity_finds_passages_late_in_long_texts():
    m = toxicity.Model({"idiot$": 4.0, "scum$": 4.0, "pathetic$": 4.0}, 0.1, 0.05)
    filler, dense = [b"plain"] * 300, toxicity.tokens("you idiot and pathetic scum")
    found = m.passages((filler + dense) * 20)
    assert [(a, b) for a, b, *_ in found] == [(305 * k + 301, 305 * k + 304) for k in range(20)]
    # After many isolated mentions of its words.
    words = (filler + [b"idiot"] + filler + [b"scum"] + filler + [b"pathetic"]) * 10
    assert [(a, b) for a, b, *_ in m.passages(words + filler + dense)] == [(len(words) + 301, len(words) + 304)]
    # One word over and over is still no more than a little.
    assert sum(s for *_, s in toxicity.segments(m.listed([b"idiot"] * 90), m.cost)) < 4 * 6


def test_toxicity_odd_rows(spark):
    base = ["clean words about nothing at all " * 3, "you idiot and scum are pathetic scum idiot"] * 300
    docs = docs_of(spark, ODD + base)
    labels = spark.createDataFrame([(i + len(ODD), 1, i % 2) for i in range(600)] + [(None, 1, 1), (3, 1, None), (len(ODD), 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(rows) == len(ODD) + 600 and rows[0].score == rows[1].score and rows[0].n_tokens == 0
    assert all(rows[i].predicted == 0 for i in range(len(ODD))) and all(rows[len(ODD) + i].predicted == i % 2 for i in range(600))
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns and toxicity.drop_toxic(docs, labels).count() == len(ODD) + 300
    none = toxicity.score(docs, labels.where("false")).collect()
    assert len(none) == len(rows) and {r.predicted for r in none} == {0}
    assert toxicity.score(docs.where("false"), labels).count() == 0


# ---------------------------------------------------------------- 3: revisits


def test_revisits_against_brute_force(spark):
    r = random.Random(7)
    rows = []
    for i in range(400):
        kind = r.choice(["response", "revisit"])
        h = {"ETag": r.choice(["a", "b", None]), "Last-Modified": r.choice(["x", "y", None]), "Date": str(i), "Content-Type": kind}
        rows.append((i, r.choice(["http://h/p", "https://www.H/p/", "http://h/q?utm_a=1", None, "bad"]), r.choice([None, *range(40)]), kind, h, r.choice(["d", "e", None])))
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>, digest string").withColumn("hit", F.lit(1))
    got = {x.record_id: x for x in warc.resolve(df, rows_per_bucket=20).collect()}
    assert {i: tuple(x) for i, x in got.items()} == {x.record_id: tuple(x) for x in warc.resolve(df).collect()}
    key = lambda u: {"http://h/p": "h/p", "https://www.H/p/": "h/p", "http://h/q?utm_a=1": "h/q"}.get(u)
    for i, u, ts, kind, h, digest in rows:
        if kind == "response":
            assert i not in got
            continue
        before = [(t, j, g, e) for j, v, t, k, g, e in rows if k == "response" and key(v) and key(v) == key(u) and ts is not None and t is not None and t < ts]
        best = max(before, key=lambda b: b[:2], default=None)
        x = got[i]
        assert (x.response_id is None) == (best is None) and (best is None or x.response_id == best[1])
        if best is None:
            assert x.outcome == "orphan" and x.headers is None
            continue
        _, _, g, e = best
        for name, a, b in (("etag", h["ETag"], g["ETag"]), ("modified", h["Last-Modified"], g["Last-Modified"]), ("digest", digest, e)):
            if a is not None and b is not None:
                assert x.outcome == (name if a == b else "mismatch")
                break
        else:
            assert x.outcome == "unvalidated"
        if x.headers is not None:
            merged = {y.name: y.value for y in x.headers}
            assert merged["content-type"] == "response" and merged["date"] == str(i)
    assert warc.resolve(df.where("false")).count() == 0
    # One URL at one time, then once more with very long headers; equal rows stay apart.
    same = [(0, "http://h/p", 1, "response", {"etag": "a", "x": "y" * 300_000}, "d")] + [(i, "http://h/p", 2, "revisit", {"ETag": "W/a", "X": "no"}, None) for i in (5, 5, *range(6, 60))]
    rows = warc.resolve(spark.createDataFrame(same, df.drop("hit").schema), rows_per_bucket=3).collect()
    assert len(rows) == 56 and {(x.response_id, x.outcome, len(x.headers[1].value)) for x in rows} == {(0, "etag", 300_000)}


# ---------------------------------------------------------------- 4: tool calls


def test_tool_calls(spark):
    calls = [
        (1, 0, "a", "search", '{"limit": 1, "query": "x"}'),
        (1, 2, "b", "lookup", '{"id": 1.5, "after": "a"}'),
        (1, 4, "c", "rate", '{"score": 2, "after": ["a", "b"], "odd": {"z":1,"y":[ 2 ]}}'),
        (1, 6, "d", "rate", '{"score": 1, "after": "e"}'),
        (1, 7, "e", "rate", '{"score": 1, "after": "d"}'),
        (1, 8, "f", "nothing", "[1]"),
        (1, 9, "g", "rate", '{"score": 1, "after": "zz"}'),
        (1, 0, "a", "search", '{"limit": 1, "query": "x"}'),
        (2, 0, None, "search", None),
        (None, 0, "a", "search", "{bad"),
    ]
    results = [(1, 1, "a", "ra"), (1, 5, "a", "late"), (1, 1, "b", "early"), (1, 9, "nobody", "r")]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string").withColumn("level", F.lit("clash"))
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    rows = {(x.conv_id, x.call_id): x for x in chat.link(c, r).collect()}
    a, b, cc = rows[1, "a"], rows[1, "b"], rows[1, "c"]
    assert (a.status, a.content, a.level, a.valid, a.arguments) == ("linked", "ra", 0, True, '{"limit":1,"query":"x"}')
    assert (b.status, b.level, b.errors) == ("early_result", 1, ["id is not integer"])
    assert (cc.status, cc.level, cc.errors) == ("no_result", 2, ["after is not string", "odd is unknown"])
    assert cc.arguments == '{"after":["a","b"],"odd":{"y":[2],"z":1},"score":2}'
    assert rows[1, "d"].level is None and rows[1, "e"].level is None
    assert rows[1, "f"].errors == ["not an object"] and rows[1, "f"].arguments is None
    assert rows[1, "g"].errors == ["zz is an unknown call"] and rows[1, "g"].level == 0
    assert rows[2, None].status == "no_result" and rows[None, "a"].arguments is None
    assert [x.call_id for x in chat.orphan_results(c, r).collect()] == ["nobody"]
    assert chat.link(c.where("false"), r).count() == 0


def test_canonical_json(spark):
    forms = {"1e2": "100", "100.0": "100", "100": "100", "-0": "0", "-0.0": "0", "0.50": "0.5", "5E-1": "0.5", "1e21": "1e+21", "1.5e300": "1.5e+300", "1e-7": "1e-7", "-2.5e-9": "-2.5e-9", "0.000001": "0.000001", "1.25e-5": "0.0000125", "1e20": "100000000000000000000", "9007199254740993": "9007199254740993", "12345678.5": "12345678.5", "-0.001": "-0.001"}
    calls = [(1, i, f"k{i}", "t", '{ "z" : %s, "a":{"y":[%s , "1e2 \\\\ \\"1.0\\"", true,null]}}' % (x, x)) for i, x in enumerate(forms)]
    calls.append((1, 99, "long", "t", '{"b": "' + "x1.0\\\\" * 60_000 + '", "a": 1.0}'))
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string")
    r = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    rows = {x.call_id: x.arguments for x in chat.link(c, r).collect()}
    for i, v in enumerate(forms.values()):
        assert rows[f"k{i}"] == '{"a":{"y":[%s,"1e2 \\\\ \\"1.0\\"",true,null]},"z":%s}' % (v, v)
    assert rows["long"] == '{"a":1,"b":"' + "x1.0\\\\" * 60_000 + '"}'


def test_positions_of_a_long_conversation(spark):
    n = 5 * chat.TURNS + 7
    rows = [(1, i, f"k{i:05}", "x", '{"after": "k%05d"}' % (i - 1) if i % 3 == 2 else "{}") for i in range(n)] + [(None, i, "k", "x", "{}") for i in range(5)] + [(2, None, "k", "x", "{}"), (2, 0, None, "x", "{}")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, name string, arguments string")
    r = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = chat.link(c, r).collect()
    order = sorted(range(n), key=lambda i: (i % 3 == 2, i))
    assert {x.call_id: x.position for x in got if x.conv_id == 1} == {f"k{i:05}": k for k, i in enumerate(order, 1)}
    assert [(x.level, x.position) for x in got if x.conv_id is None] == [(0, None)] * 5
    assert sorted((x.position or 0, x.level) for x in got if x.conv_id == 2) == [(0, 0), (1, 0)]


def test_levels_of_random_dependencies(spark):
    r = random.Random(31)
    rows, want = [], {}
    for conv in range(14):
        n = r.choice([1, 2, 9, 70])
        deps = {}
        for i in range(n):
            pool = list(range(n)) if conv % 3 == 2 else list(range(i))
            deps[i] = r.sample(pool, min(len(pool), r.choice([0, 1, 1, 1, 1, 2, 3]))) if conv % 3 else ([i - 1] if i else [])
        level = {}
        while True:
            new = {i: 1 + max((level[d] for d in ds), default=-1) for i, ds in deps.items() if i not in level and all(d in level for d in ds)}
            if not new:
                break
            level |= new
        for i, ds in deps.items():
            rows.append((conv, i, f"k{i}", "x", '{"after": [' + ", ".join(f'"k{d}"' for d in ds) + "]}"))
            want[conv, f"k{i}"] = level.get(i)
    calls = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    assert {(x.conv_id, x.call_id): x.level for x in chat.link(calls, results).collect()} == want


# ---------------------------------------------------------------- 5: decontamination


def test_decontamination_against_brute_force(spark):
    r = random.Random(11)
    vocab = ["alpha", "Beta", "gamma", "délta", "eps-ilon", "z9"]
    make = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = {i: make(n) for i, n in enumerate([1, 3, 7, 8, 9, 30])} | {10: "", 11: None, 12: "alpha Beta alpha"}
    texts = [*ODD, *[make(r.randrange(0, 60)) for _ in range(60)], "x " + items[5] + " y"]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = decontam.brute_force(dict(enumerate(texts[:7] + texts[9:])), items)
    want = {(i if i < 7 else i + 2): v for i, v in want.items()}
    for block in (1, 10**6):
        rows = decontam.mark(docs, bench, block_bytes=block).collect()
        for x in rows:
            if x.doc_id in want:
                c = x.contamination
                assert (c.n_words, c.n_hit, len(c.item_ids)) == want[x.doc_id][:3], x.doc_id
                for s in c.spans:
                    assert decontam.words(x.text[s.start : s.end])
    got = {x.doc_id: tuple(x)[1:] for x in decontam.digest(docs, bench).collect()}
    assert all(got[i] == v for i, v in want.items())
    assert decontam.digest(docs.where("false"), bench).count() == 0
    assert {x.n_items for x in decontam.digest(docs, bench.where("false")).collect()} == {0}
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and len(texts) - 1 not in {x.doc_id for x in clean.collect()}


# ---------------------------------------------------------------- 6: packing


def test_successor_is_the_tightest_compatible_bin():
    r = random.Random(13)
    bins = packing.Bins(64)
    for _ in range(600):
        size, mask = r.randrange(1, 65), sum(1 << r.randrange(6) for _ in range(r.randrange(3)))
        fits = [(f, b) for b, (f, m) in enumerate(zip(bins.free, bins.mask, strict=True)) if f >= size and f and not m & mask]
        found = bins.successor(size, mask)
        assert (found is None) == (not fits)
        if fits:
            assert bins.free[found] == min(fits)[0] and not bins.mask[found] & mask
        bins.place(size, mask)
    assert all(f >= 0 for f in bins.free)


def test_packing(spark):
    r = random.Random(17)
    texts = [*ODD, *["w " * r.randrange(0, 700) for _ in range(300)], *["same text here"] * 40]
    sources = [None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}" for i in range(len(texts))]
    docs = docs_of(spark, texts, ids=[None, 1, 1, *range(3, len(texts))], sources=sources)
    rows = packing.pack(docs, capacity=1000, block=100).collect()
    by_bin, by_doc = defaultdict(list), defaultdict(list)
    for x in rows:
        by_bin[x.bin_id].append(x)
        by_doc[x.doc_id].append(x)
    for b in by_bin.values():
        b.sort(key=lambda x: x.bin_offset)
        assert sum(x.n_tokens for x in b) == b[0].bin_tokens <= 1000
        assert [x.bin_offset for x in b] == np.cumsum([0, *[x.n_tokens for x in b]])[:-1].tolist()
        for name in ("source", "cluster"):
            seen = [x[name] for x in b if x[name] is not None]
            assert len(seen) == len(set(seen))
    want = sorted(len(space_words(t)) + 1 for t in texts)
    assert sum(x.n_tokens for x in rows) == sum(want)
    long = sorted(by_doc[8], key=lambda x: x.piece)
    assert [x.first_token for x in long] == list(range(0, 40_001, 1000)) and len(by_doc[None]) == 1
    assert packing.pack(docs.where("false")).count() == 0


def test_packing_against_brute_force(spark):
    from llm_brute import best_fit

    r = random.Random(43)
    texts = [*ODD, *["w " * r.randrange(0, 700) for _ in range(250)], *["same text here"] * 30]
    sources = [None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}" for i in range(len(texts))]
    rows = packing.pack(docs_of(spark, texts, sources=sources), capacity=1000).collect()
    want = best_fit({i: (t, s) for i, (t, s) in enumerate(zip(texts, sources, strict=True))}, 1000)
    assert {(x.doc_id, x.piece): (x.first_token, x.n_tokens, x.bin_id, x.bin_offset, x.bin_tokens) for x in rows} == want


def test_packing_in_blocks_fills_bins_as_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    bins = {n: packing.pack(docs, block=n).select("bin_id").distinct().count() for n in (10**6, 2048)}
    assert bins[2048] <= 1.03 * bins[10**6], bins


# ---------------------------------------------------------------- 7: exact copies


def test_exact_dedup_against_brute_force(spark):
    texts = [*ODD, "a b c", "ab c ", "a bc", "abc", "abd", "x" * 300 + "1", "x" * 300 + "2", " x" * 300 + "1"]
    ids = list(range(len(texts)))
    ids[1] = None
    rows = exact_dedup.exact_groups(docs_of(spark, texts, ids)).collect()
    norm = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[norm(t)].append((-len(t or ""), i is None, i if i is not None else 0, i))
    want = Counter()
    for n, g in groups.items():
        best = min(g)
        want.update((i, best[3], len(g), (a, b, c, i) == best, hashlib.sha256(n.encode()).hexdigest()) for a, b, c, i in g)
    assert Counter(tuple(x) for x in rows) == want
    assert exact_dedup.exact_groups(docs_of(spark, [])).count() == 0


def test_exact_dedup_of_repeated_rows(spark):
    docs = docs_of(spark, ["a b", "a b", "a b ", "c", "c", "d"], ids=[1, 1, 2, 3, 3, None])
    rows = exact_dedup.exact_groups(docs).collect()
    assert sum(x.kept for x in rows) == 3 and len(rows) == 6
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((x.text for x in left.collect())) == ["a b ", "c", "d"]


def test_copies_are_dropped_by_row(spark):
    # A null id beside a keeper that has one; an id that stands for a text of its own as well.
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    ids, texts = [None, 5, 1, 1, 0, None, None, 7, 7], [x, x, y, z, z, "q r", "q r", "s", "s"]
    docs = docs_of(spark, texts, ids)
    want = Counter([(5, x), (1, y), (0, z), (None, "q r"), (7, "s")])
    for drop in (exact_dedup.drop_copies, ngram_join.drop_near_copies):
        left = drop(docs)
        assert left.columns == docs.columns and Counter((r.doc_id, r.text) for r in left.collect()) == want
    near = docs_of(spark, [x, x + " more", y, z, z + " more"], [None, 5, 1, 1, 0])
    assert Counter((r.doc_id, r.text) for r in ngram_join.drop_near_copies(near).collect()) == Counter([(5, x + " more"), (1, y), (0, z + " more")])


CLASHES = ["__drop", "__again", "__norm", "__own", "__own_", "__id", "__mark", "__rank", "__more", "contamination", "__contamination", "toxicity", "__toxicity", "len", "prefix", "norm", "sha", "same", "n"]


def test_stages_keep_columns_of_any_name(spark):
    base = " ".join(f"b{i}" for i in range(40))
    texts = [base, base + " ", base + " c", "one two", None, "x y z"]
    docs = spark.createDataFrame([(i, t, *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)], ", ".join(["doc_id long", "text string", *[f"`{c}` string" for c in CLASHES]]))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one two"), (2, "one two")], "item_id long, text string")
    stages = {
        exact_dedup.drop_copies: {1, 2, 3, 4, 5},
        ngram_join.drop_near_copies: {0, 3, 4, 5},
        lambda d: toxicity.drop_toxic(d, labels): set(range(6)),
        lambda d: decontam.drop_contaminated(d, bench): {0, 1, 2, 4, 5},
    }
    for stage, want in stages.items():
        left = stage(docs)
        assert left.columns == docs.columns
        rows = left.collect()
        assert {x.doc_id for x in rows} == want and all(x[c] == f"{c}{x.doc_id}" for x in rows for c in CLASHES)
    marked = decontam.mark(docs, bench, block_bytes=1)
    assert marked.columns[: len(docs.columns)] == docs.columns and len(marked.columns) == len(docs.columns) + 1
    assert common.fresh(["A", "a_"], "a", "b", "b") == ["a__", "b", "b_"]


def test_long_lists_of_lost_rows_are_shuffled(spark):
    docs = docs_of(spark, ["a", "b", "b", "c", None], ids=[1, 2, 2, None, None])
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    key = docs.select(F.col("doc_id").alias("id"), mark.alias("mark"), "text")
    for limit in (0, 100):
        left = common.drop_rows(docs, key.where("text = 'a' or text is null").drop("text"), key.where("text = 'b'").drop("text"), mark, broadcast_rows=limit)
        assert Counter((x.doc_id, x.text) for x in left.collect()) == Counter([(2, "b"), (None, "c")])


# ---------------------------------------------------------------- 8: shards


def test_sharding(spark):
    r = random.Random(19)
    texts = [*ODD[:7], *["hot text"] * 900, *["".join(r.choice("abc ") for _ in range(r.randrange(200))) for _ in range(900)]]
    ids = [None, 0, 0, *range(3, len(texts))]
    docs = docs_of(spark, texts, ids)
    for per in (10, 10**6):
        rows = sharding.shard(docs, rows_per_range=per).collect()
        assert Counter(x.doc_id for x in rows) == Counter(ids)
        total = sum(x.size for x in rows)
        by = defaultdict(list)
        for x in rows:
            by[x.shard].append(x)
        assert sorted(by) == list(range(8)) and all(abs(sum(x.size for x in b) - total / 8) < 500 for b in by.values())
        assert all(sorted(x.slot for x in b) == list(range(len(b))) for b in by.values())
        text = dict(zip(ids, texts, strict=True))
        assert all(x.text_crc32 == zlib.crc32((text[x.doc_id] or "").encode()) and x.size == len((text[x.doc_id] or "").encode()) + 1 for x in rows if x.doc_id not in (0, None))
        places = [(x.doc_id, x.shard, x.slot) for x in rows if x.doc_id not in (0,)]
        first = sorted(places, key=str) if per == 10 else first
        assert sorted(places, key=str) == first  # the sample never shows
        copies = defaultdict(set)
        for x in rows:
            copies[text.get(x.doc_id) if x.doc_id not in (0, None) else x.doc_id].add((x.shard, x.whole))
        assert all({w for _, w in c} == {len({s for s, _ in c}) == 1} for t, c in copies.items() if t not in (0, None))
    assert sharding.shard(docs.where("text = 'hot text'")).where("whole").count() == 0
    # Nothing but one row, again and again.
    alike = sharding.shard(docs_of(spark, ["same"] * 500, [5] * 500), rows_per_range=10).collect()
    assert sorted(Counter(x.shard for x in alike).values()) == [62] * 4 + [63] * 4 and len({(x.shard, x.slot) for x in alike}) == 500
    # More splitters than a plan could hold as literals.
    many = sharding.shard(docs.select("*"), rows_per_range=1).groupBy("shard").count().collect()
    assert sum(x["count"] for x in many) == len(texts)
    assert sharding.shard(docs.where("false")).count() == 0
    assert {x.law for x in rows} == {"bytes"} and {x.grown_shard for x in rows} == {None}


# ---------------------------------------------------------------- 9: near copies


def jaccard_groups(texts, ids):
    sets = []
    for t in texts:
        w = space_words(t)
        sets.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
                    links += 1
    low = {}
    for i in range(len(texts)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return Counter((ids[i], len(sets[i]), low[find(i)]) for i in range(len(texts))), links


def test_ngram_join_against_brute_force(spark):
    r = random.Random(23)
    words = [f"w{i}" for i in range(400)]
    texts = list(ODD)
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randrange(6, 120))]
        for _ in range(14):
            t = list(base)
            for _ in range(r.randrange(0, 4)):
                t[r.randrange(len(t))] = r.choice(words)
            texts.append(" ".join(t[: len(t) - r.randrange(0, 5)]))
    common_part = [r.choice(words) for _ in range(60)]
    texts += [" ".join([r.choice(words) for _ in range(r.randrange(0, 30))] + common_part) for _ in range(60)]
    texts += ["A b  c", "a B\tc", "a b d"]
    order = list(range(len(texts)))
    r.shuffle(order)
    want, n = jaccard_groups(texts, order)
    got = Counter(tuple(x) for x in ngram_join.groups(docs_of(spark, texts, order)).collect())
    assert n > 300 and got == want
    assert ngram_join.groups(docs_of(spark, [])).count() == 0
    left = ngram_join.drop_near_copies(docs_of(spark, texts, order))
    assert sorted(x.doc_id for x in left.collect()) == sorted(i for i, _, c in want if i == c)


def test_ngram_join_of_a_widespread_passage(spark):
    r = random.Random(5)
    passage = [f"p{i}" for i in range(24)]
    new = lambda n: [f"n{r.randrange(10**9)}" for _ in range(n)]
    # Alone, the passage asks for more matches than those that add rare words to it do.
    texts = [" ".join(passage), *(" ".join(passage + new(5)) for _ in range(4))]
    texts += [" ".join(new(150) + passage + new(150)) for _ in range(300)]
    order = list(range(len(texts)))
    want, n = jaccard_groups(texts, order)
    got = Counter(tuple(x) for x in ngram_join.groups(docs_of(spark, texts, order)).collect())
    assert n == 4 and got == want


def test_ngram_join_of_a_text_and_its_extensions(spark):
    # 80 shingles against 100: the smaller set asks for more matches than any larger one gives it.
    base = [f"w{i}" for i in range(84)]
    texts = [" ".join(base), *(" ".join(base + [f"b{k}u{i}" for i in range(20)]) for k in range(14))]
    rows = ngram_join.groups(docs_of(spark, texts)).collect()
    assert {tuple(x) for x in rows} == {(i, 100 if i else 80, 0) for i in range(15)}


def small_corpora(r, n):
    """Corpora of variants with words of their own: extended, cut, changed, or a shared passage between others."""
    texts, want = [], Counter()
    for c in range(n):
        word = lambda c=c: f"c{c}_{r.randrange(60)}"
        new = lambda n, c=c: [f"c{c}n{r.randrange(10**9)}" for _ in range(n)]
        base, own = [word() for _ in range(r.randrange(5, 130))], []
        for _ in range(r.randrange(2, 16)):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                t[r.randrange(len(t))] = r.choice([word(), *new(1)])
            t = t[r.randrange(3) :] if r.random() < 0.3 else t
            t += new(r.choice([0, 0, 1, len(base) // 5, len(base) // 4, len(base) // 3]))
            if r.random() < 0.2:
                t = new(r.randrange(40)) + t + new(r.randrange(40))
            own.append(" ".join(t))
        ids = list(range(len(texts), len(texts) + len(own)))
        want += jaccard_groups(own, ids)[0]
        texts += own
    return texts, want


@pytest.mark.parametrize("hot", [ngram_join.HOT, 2])
def test_ngram_join_of_many_small_corpora(spark, monkeypatch, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "WIDTH", 1 << 12)  # crowded counters
    texts, want = small_corpora(random.Random(41 + hot), 60)
    got = Counter(tuple(x) for x in ngram_join.groups(docs_of(spark, texts)).collect())
    assert got == want and len({c for *_, c in want}) < len(texts) - 50


def test_what_stands_out_of_a_crowded_sketch():
    r = np.random.default_rng(3)
    sketch = r.poisson(10_000, 1 << 16).astype(np.uint32)
    middle, least = ngram_join.usual(sketch)
    assert abs(middle - 10_000) < 20 and 400 < least < 1000
    assert (sketch - middle > least).sum() < 5
    assert ngram_join.usual(np.zeros(64, np.uint32)) == (0.0, 2.0)


def test_ngram_join_counts_all_links(spark):
    r = random.Random(8)
    texts = [None, "", "a b c", "a B c"]
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(110)]
        for _ in range(12):
            t = list(base)
            t[r.randrange(110)] = f"n{r.randrange(10**9)}"
            texts.append(" ".join(t))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := space_words(t)) else set() for t in texts]
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    want = {i: sum(1 for j, y in enumerate(sets) if i != j and near(x, y)) for i, x in enumerate(sets)}
    rows = ngram_join.link_counts(docs_of(spark, texts)).collect()
    assert {x.doc_id: x.n_links for x in rows} == want and len(rows) == len(texts) and max(want.values()) > 3


def test_ngram_join_without_any_link(spark):
    docs = docs_of(spark, ["a b c d e f", "g h i j k l", "m n o", "", None])
    rows = {r.doc_id: tuple(r)[1:] for r in ngram_join.groups(docs).collect()}
    assert rows == {0: (2, 0), 1: (2, 1), 2: (1, 2), 3: (0, 3), 4: (0, 4)}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[95] == got[90] == 90


# ---------------------------------------------------------------- 10: context trees


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 3, 10.5, 1000, 1e7])
    assert np.allclose(ctw.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def ctw_brute(train, text):
    """log10 probability of a text: one context tree for each bit prefix, written recursively."""
    streams = [ctw.frame(t) for t in train]
    counts = defaultdict(lambda: [0, 0])
    for s in streams:
        for i in range(ctw.DEPTH, len(s)):
            for k in range(8):
                prefix, bit = (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1
                for d in range(ctw.DEPTH + 1):
                    counts[s[i - d : i], prefix][bit] += 1
    children = defaultdict(set)
    for ctx, prefix in counts:
        if ctx:
            children[ctx[1:], prefix].add(ctx)

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def log_pw(ctx, prefix):
        if (ctx, prefix) not in memo:
            kt = log_kt(*counts[ctx, prefix]) if (ctx, prefix) in counts else 0.0
            if len(ctx) < ctw.DEPTH and (ctx, prefix) in counts:
                below = sum(log_pw(c, prefix) for c in children[ctx, prefix])
                kt = np.logaddexp(math.log(0.5) + kt, math.log(0.5) + below)
            memo[ctx, prefix] = kt
        return memo[ctx, prefix]

    def p(s, i, d, prefix, bit):
        ctx = s[i - d : i]
        if (ctx, prefix) not in counts:
            return 0.5
        c = counts[ctx, prefix]
        own = (c[bit] + 0.5) / (sum(c) + 1)
        if d == ctw.DEPTH:
            return own
        share = math.exp(math.log(0.5) + log_kt(*c) - log_pw(ctx, prefix))
        return share * own + (1 - share) * p(s, i, d + 1, prefix, bit)

    s, total = ctw.frame(text), 0.0
    for i in range(ctw.DEPTH, len(s)):
        for k in range(8):
            total += math.log10(p(s, i, 0, (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1))
    return total


def test_ctw_against_brute_force(spark):
    texts = [None, "", "abra cadabra", "Abra", "the cat sat", "the bat sat on", "zzz é", "a" * 50, "\n\t", "the cat", "abra cadabra"]
    docs = docs_of(spark, texts)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    train = [(t or "").encode() for t, h in zip(texts, held, strict=True) if not h]
    tokens = [[*space_words(t), None] for t in texts]
    seen = Counter(w for ts, h in zip(tokens, held, strict=True) if not h for w in ts)
    n, v = sum(seen.values()), len(seen)
    rows = {r.doc_id: r for r in ctw.score(docs, block_bytes=40, group_grams=9).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        assert r.held_out == held[i] and r.train_tokens == n and r.n_tokens == len(tokens[i]) and r.n_known == sum(seen[w] > 0 for w in tokens[i])
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens[i]))
        assert r.score == pytest.approx(ctw_brute(train, (t or "").encode()), rel=1e-9)
    assert ctw.score(docs.where("false")).count() == 0


def test_ctw_without_learning_rows(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = ctw.score(docs_of(spark, ["ab", "", None], ids)).collect()
    assert all(r.base_score == 0 and r.score == pytest.approx(8 * r.n_bytes * math.log10(0.5)) for r in rows)


def test_ctw_probabilities_sum_to_one(spark):
    """Over all bytes after one context: each 6-gram's value comes from one conditional distribution."""
    r = random.Random(29)
    keys = np.unique(np.array([(int.from_bytes(bytes([r.randrange(97, 100) for _ in range(ctw.DEPTH)]), "big") << 8) | r.randrange(97, 100) for _ in range(200)], np.int64))
    n = np.array([r.randrange(0, 20) for _ in keys], float)
    ctx = int(keys[0]) >> 8
    full = np.array([(ctx << 8) | s for s in range(256)], np.int64)
    every = np.unique(np.concatenate([keys, full]))
    weight = np.zeros(len(every))
    weight[np.searchsorted(every, keys)] = n
    p, _, tops = ctw.subtree(every, weight, top=0)
    at = np.searchsorted(every, full)
    assert p[at].prod(1).sum() == pytest.approx(1.0)


def test_ctw_scores_held_out_text_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = ctw.score(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_bytes").alias("n")).first()
    assert r.s > r.b and -r.s * math.log2(10) / r.n < 2.3
