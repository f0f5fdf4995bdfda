"""Each operator against a brute-force version, on odd rows and on the smallest tables."""

import hashlib
import io
import random
import re
import wave
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from varspan.llm import op01_secrets, op02_repeats, op03_license, op04_decontaminate, op05_url_trust, op06_quality, op07_perspectives, op08_setjoin, op09_packing, op10_media, queries

P = "The quick brown fox jumps over the lazy dog and then, quite unexpectedly, it goes on to sleep beside the old mill. " * 3
COPY = " ".join(f"w{k * 7919 % 1000}" for k in range(120))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, COPY), (5, COPY), (6, COPY.replace("w919", "x")), (7, P), (8, "Start. " + P), (9, "a b c"), (10, "A  b\nC"),
    (11, "Licensed under CC BY-NC 4.0. All rights reserved. ALL RIGHTS   RESERVED"), (12, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" here'),
    (13, "for " * 5000), (14, "éü" * 300 + P + "é"), (15, "GNU General Public License\u212a general public license"), (16, "x" * 150_000), (17, "<|endoftext|> is  text"), (18, "one two three four five six"),
    (18, "one two three four five six"), (None, COPY + " tail"), (19, "\u0130 K \u212a key"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, i long, key string, bucket long, at long, n long, cid long, host string, path string, part int, ids string, value string, bins string, spans string, words string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "s/x", len(t or ""), k, "k", k, k, k, k, "h", "p", k, "i", "v", "b", "s", "w") for k, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def words(text):
    b = (text or "").encode()
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(c + 32 if 65 <= c <= 90 else c for c in b))


# --- 2


def brute_repeats(rows):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            if (w := b[p : p + 100]) in seen:
                cover[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out[d] = (len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return out


def repeats(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op02_repeats.query(df).collect()}


def test_repeats(spark, odd, none):
    assert repeats(odd) == brute_repeats(dict(TEXTS).items())
    assert repeats(none) == {}
    docs = read(spark, "documents")
    assert repeats(docs) == brute_repeats([(r.doc_id, r.text) for r in docs.collect()])


def test_repeats_of_hot_texts(spark, odd, monkeypatch):
    monkeypatch.setattr(op02_repeats, "HOT_ROWS", 1)
    assert repeats(odd) == brute_repeats(dict(TEXTS).items())
    docs = spark.createDataFrame([(k, f"{k} " + P) for k in range(40)], "doc_id long, text string").repartition(4)
    assert repeats(docs) == brute_repeats([(r.doc_id, r.text) for r in docs.collect()])


def test_hot_texts_are_a_share_of_the_rows(spark):
    """The same texts at two sizes of the input, and few of them."""
    rows = [(k, k, 0, 200 if k < 3 else 1 + k % 9) for k in range(2000)]
    for x in (1, 100):
        first = spark.createDataFrame([(b, t, i, n * x) for b, t, i, n in rows], "bucket long, text long, first long, n long")
        assert {r.text for r in op02_repeats.hot_texts(first).collect()} >= {0, 1, 2}
        assert op02_repeats.hot_texts(first).count() <= op02_repeats.HOT_TEXTS
    assert op02_repeats.hot_texts(spark.createDataFrame([(1, 1, 0, 200)], first.schema)).count() == 1


def test_repeats_without_filters(spark, odd, monkeypatch):
    monkeypatch.setattr(op02_repeats, "FILTER_BITS", 0)
    assert repeats(odd) == brute_repeats(dict(TEXTS).items())


@pytest.mark.parametrize("most", [op02_repeats.BROADCAST_IDS, 0])
def test_repeats_of_rows_that_share_an_id(spark, monkeypatch, most):
    monkeypatch.setattr(op02_repeats, "BROADCAST_IDS", most)
    text = lambda step: " ".join(f"{step}v{k * step % 1009}" for k in range(1, 90))
    a, b, c, shared, d, e = map(text, (7, 11, 13, 17, 19, 23))
    rows = [(None, P), (None, COPY), (None, COPY), (None, a), (-(1 << 63), COPY), (-(1 << 63), b), (4, c), (5, c), (5, d), (6, d), (7, shared + "|" + e), (7, "xyz" + shared), (8, e), (9, "short"), (None, "short"), (None, "short")]
    got = op02_repeats.cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    left = sorted(((r.doc_id, r.kept.decode()) for r in got if r.doc_id != 7), key=repr)
    kept_p = next(t for i, t in left if i is None and t[:5] == P[:5])
    assert 100 < len(kept_p) < len(P) / 2
    want = [(None, kept_p), (None, COPY), (None, ""), (None, a), (-(1 << 63), ""), (-(1 << 63), b), (4, c), (5, ""), (5, d), (6, ""), (8, ""), (9, "short"), (None, "short"), (None, "short")]
    assert left == sorted(want, key=repr)
    seven = {r.kept.decode() for r in got if r.doc_id == 7}
    assert seven in ({shared + "|" + e, "xyz"}, {"|" + e, "xyz" + shared})


# --- 3


def brute_license(text):
    w = words(text)
    places, labels = [], []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = [x.encode() for x in phrase.split()]
        found = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += found
        labels += [label] * bool(found)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license(spark, odd, none):
    for df in (odd, read(spark, "documents")):
        got = [((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels), r) for r in op03_license.query(df).collect()]
        want = [brute_license(r.text) for r in df.select("text").collect()]
        assert sorted(map(repr, (g for g, _ in got))) == sorted(map(repr, want))
        assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for _, r in got)
    assert op03_license.query(none).count() == 0
    labels = {r.doc_id: r.labels for r in op03_license.query(odd).collect()}
    assert labels[11] == "cc-by,cc-by-nc-4.0,reserved" and labels[15] == "gpl"


def brute_notices(text, notices, idf):
    """(labels, score) by trying every start: two of the three rarest words that the text holds agree on it within SLACK, and all key phrases are near."""
    slack = op03_license.SLACK
    w = [x.decode() for x in words(text)]
    found, best = set(), 0.0
    for t in notices:
        own = t.words.split()
        held = sorted({x for x in own if x in w}, key=lambda x: (-idf[x], x))[: op03_license.RARE]
        starts = [{i - k for i, x in enumerate(w) if x == h for k, y in enumerate(own) if y == h} for h in held]
        agreed = {a for i in range(len(starts)) for j in range(i + 1, len(starts)) for a in starts[i] if any(abs(a - b) <= slack for b in starts[j])}

        def near(s, key):
            k = key.split()
            at = next(i for i in range(len(own)) if own[i : i + len(k)] == k)
            return any(s + at + o >= 0 and w[s + at + o : s + at + o + len(k)] == k for o in range(-slack, slack + 1))

        for s in agreed:
            if all(near(s, k) for k in t.keys):
                found.add(t.label)
                best = max(best, sum(0 <= s + k < len(w) and w[s + k] == x for k, x in enumerate(own)) / len(own))
    return found, best


def test_license_labels_and_scores(spark, odd):
    lines = [t.words for t in op03_license.NOTICES]
    mixed = [x for k, line in enumerate(lines) for x in (line, "Some words. " + line.upper() + " and more " + lines[k - 1], " ".join(line.split()[2:]), line.replace(" license", " open license", 1), " ".join(reversed(line.split())))]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(mixed * 2)], "doc_id long, text string").repartition(5)
    for docs in (df, odd, read(spark, "documents")):
        rows = docs.select("doc_id", "text").collect()
        n, counts = len(rows), defaultdict(int)
        for r in rows:
            for x in {y.decode() for y in words(r.text)}:
                counts[x] += 1
        idf = defaultdict(lambda: 0.0, {x: np.log((1 + n) / (1 + counts[x])) for t in op03_license.NOTICES for x in t.words.split()})
        want = []
        for r in rows:
            labels, score = brute_notices(r.text, op03_license.NOTICES, idf)
            base = brute_license(r.text)[-1]
            want.append(repr((r.doc_id, ",".join(sorted(labels | set(filter(None, base.split(","))))), round(1.0 if base else score, 9))))
        got = [repr((r.doc_id, r.labels, round(r.score, 9))) for r in op03_license.query(docs).collect()]
        assert sorted(got) == sorted(want)


def test_license_of_a_thousand_templates(spark):
    """1000 templates of 200 words over the documents: each text made of a template is told, no other is."""
    made = lambda k: " ".join(f"t{(k * 7919 + i * i * 31) % 5003}" for i in range(200))
    table = spark.createDataFrame([(f"l{k}", made(k), [" ".join(made(k).split()[50:56])]) for k in range(1000)], "label string, text string, key_phrases array<string>")
    docs = spark.createDataFrame([(-k, "Before it. " + made(k * 100)) for k in range(1, 10)], "doc_id long, text string").unionByName(read(spark, "documents").select("doc_id", "text"))
    got = {r.doc_id: r for r in op03_license.scan(docs, notices=table).where("score > 0 and doc_id < 0").collect()}
    assert {d: (r.labels, r.score) for d, r in got.items()} == {-k: (f"l{k * 100}", 1.0) for k in range(1, 10)}


def test_license_templates_from_a_table(spark):
    table = spark.createDataFrame([("own", "Copying of this Thing is allowed on Tuesdays only.", ["allowed on Tuesdays"]), ("all", "No copying whatsoever", None)], "label string, text string, key_phrases array<string>")
    docs = spark.createDataFrame([(1, "x. Copying of this fine thing is allowed on tuesdays only!"), (2, "no COPYING whatsoever"), (3, "copying of this thing is allowed on mondays only")], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in op03_license.scan(docs, notices=table).collect()} == {1: "own", 2: "all", 3: ""}


# --- 4


def brute_hits(text, items):
    w, hit, found = words(text), set(), set()
    for i, t in items:
        x = words(t)
        n = min(10, len(x))
        windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found.add("" if i is None else str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontaminate(spark, odd, none, monkeypatch):
    items = [(1, P[20:200]), (2, "B c"), (3, None), (4, ""), (10, "quite unexpectedly it goes on to sleep beside the old mill the quick brown fox"), (2, "B c"), (None, "for " * 30), (None, "one two three four five")]
    few = spark.createDataFrame(items, "item_id long, text string")
    want = [repr(brute_hits(t, items)) for _, t in TEXTS]
    show = lambda df: sorted(repr((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in df.collect())
    assert show(op04_decontaminate.query(odd, few)) == sorted(want)
    monkeypatch.setattr(op04_decontaminate, "BLOCK_BYTES", 10)  # a block for each item
    assert show(op04_decontaminate.query(odd, few)) == sorted(want)
    assert op04_decontaminate.remove(odd, few).count() == sum(not brute_hits(t, items)[-1] for _, t in TEXTS)
    monkeypatch.undo()
    assert op04_decontaminate.query(none, few).count() == 0
    assert op04_decontaminate.query(odd, few.limit(0)).where("contaminated").count() == 0
    docs, bench = read(spark, "documents"), [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]
    assert show(op04_decontaminate.query(docs, read(spark, "benchmark"))) == sorted(repr(brute_hits(r.text, bench)) for r in docs.collect())
    left = op04_decontaminate.remove(odd, few)
    assert left.columns == odd.columns and left.count() == sum(not brute_hits(t, items)[-1] for _, t in TEXTS)


def test_longest_match_has_its_place(spark):
    docs = spark.createDataFrame([(1, "zz " + P)], "doc_id long, text string")
    few = spark.createDataFrame([(5, P.split("beside")[0][4:])], "item_id long, text string")
    spans = op04_decontaminate.find(docs, few).first().spans
    assert max((s.length, -s.start) for s in spans) == (len(words(P.split("beside")[0][4:])), -2)


# --- 5


def brute_rule(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Net", "HTTP://x.net/", "http://a.example.net/en/1", "http://a.example.net/eN/", "http://Ä.example.com/de/?q#f", "x://b.org/fr/a://c", "http://notnet/", "http://org/fr/", "//a.net/", "http://a.example.com/de", "http://a\nb.net/x"]
    page = '<a href="https://b.org/x">y</a><img src=//A.net/i.png>'
    odd = spark.createDataFrame([(k, u, page if k % 2 else None, "h", 1.0) for k, u in enumerate(urls + urls[:3])], "page_id long, url string, html string, host string, rank double")
    for df in (odd, read(spark, "pages")):
        got = {r.page_id: r for r in op05_url_trust.query(df).collect()}
        for r in df.collect():
            host, path, best = brute_rule(r.url)
            g = got[r.page_id]
            assert (g.host, g.path, g.rule) == (host, path, best and best[1])
            assert g.verdict == best[0] if best else g.verdict in ("allow", "block")
    assert op05_url_trust.query(odd.limit(0)).count() == 0


def test_propagation_is_pagerank(spark):
    edges = [("a", "b", 1.0), ("b", "c", 3.0), ("b", "a", 1.0), ("d", "c", 2.0)]
    seeds = [("a", 2, 0), ("c", 0, 1), ("d", 1, 0)]
    got = {r.host: (r.trust, r.distrust) for r in op05_url_trust.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "host string, n_allow long, n_block long")).collect()}
    names = "abcd"
    for kind, pairs, mass in ((0, edges, {"a": 2 / 3, "d": 1 / 3}), (1, [(v, u, w) for u, v, w in edges], {"c": 1.0})):
        total = defaultdict(float)
        for u, _, w in pairs:
            total[u] += w
        rank = {n: mass.get(n, 0.0) for n in names}
        for _ in range(op05_url_trust.ROUNDS):
            new = {n: 0.15 * mass.get(n, 0.0) for n in names}
            for u, v, w in pairs:
                new[v] += 0.85 * rank[u] * w / total[u]
            rank = new
        assert all(abs(got.get(n, (0, 0))[kind] - rank[n]) < 1e-9 for n in names)


def test_strangers_under_a_public_suffix(spark):
    urls = ["http://bad.co.uk/", "http://good.co.uk/", "http://x.bad.example.org/", "http://bad.example.org/"]
    df = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in op05_url_trust.judge(df, (("block", "bad.co.uk/"), ("block", "bad.example.org/"))).collect()}
    assert got == {0: "block", 1: "allow", 2: "block", 3: "block"}
    edges = op05_url_trust.host_edges(df.withColumn("host", op05_url_trust.host(F.col("url"))), df.select(op05_url_trust.host(F.col("url")).alias("host")).distinct())
    assert {(r.src, r.dst) for r in edges.collect()} == {(a, b) for x, y in (("x.bad.example.org", "bad.example.org"), ("bad.example.org", "example.org")) for a, b in ((x, y), (y, x))}


def test_trust_settles_on_a_long_chain(spark):
    hosts = ["bad.net", *(f"h{k}.xy" for k in range(12))]
    pages = [(k, f"http://{h}/", f'<a href="http://{hosts[k - 1]}/">x</a>' if k else None) for k, h in enumerate(hosts)]
    got = {r.page_id: r for r in op05_url_trust.query(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k].verdict == "block" and abs(got[k].distrust - 0.15 * 0.85**k) < 1e-6 for k in range(len(hosts)))


# --- 6


def test_quality_held_out(spark, odd, none):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = op06_quality.judge(docs, labels.where("doc_id % 2 = 0"))
    r = got.join(labels.where("doc_id % 2 = 1"), "doc_id").select((F.col("keep") == (F.col("quality") == 1)).alias("ok"), "quality").groupBy("quality").agg(F.avg(F.col("ok").cast("int")).alias("a")).collect()
    assert min(x.a for x in r) >= 0.9 and got.count() == docs.count()
    for few in (labels.limit(0), labels):
        kept = op06_quality.filter_quality(odd, few)
        assert kept.columns == odd.columns and kept.count() == odd.count()  # no labels of these documents that reject any
    assert op06_quality.judge(none, labels).count() == 0
    assert op06_quality.judge(odd, labels).count() == len(TEXTS)


def test_quality_shrinkage_by_hand(spark):
    rows = [(k, f"h{k % 3}" if k % 7 else None, f"p{k % 2}", (k * 37 % 100) / 100, (k * 53 % 11 - 5) / 2) for k in range(60)] + [(60, "lone", "p0", 0.9, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, p double, evidence double")
    model = op06_quality.Model(((0.0,) * 8,) * 5, 0.5)
    priors, strength = op06_quality.path_priors(df, model)
    got = {r.doc_id: (r.host_mean, r.path_mean, r.posterior) for r in op06_quality._judged(df, priors, strength).collect()}

    def moments(groups):  # (n, s, mean)
        groups = [g for g in groups if g[0] >= 2]
        v = [m * (1 - m) for _, _, m in groups]
        n = sum(g[0] for g in groups)
        spread = max(0.0, (sum(k * (s / k - m) ** 2 for k, s, m in groups) - sum(v)) / n)
        return min(1000.0, max(1.0, sum(g[0] * x for g, x in zip(groups, v, strict=True)) / n / spread - 1)) if spread > 0 else 1000.0

    total = sum(r[3] for r in rows) / len(rows)
    of = lambda key: {k: [r[3] for r in rows if key(r) == k] for k in {key(r) for r in rows}}
    hosts, paths = of(lambda r: r[1]), of(lambda r: (r[1], r[2]))
    k1 = moments([(len(x), sum(x), total) for x in hosts.values()])
    host_mean = {h: (sum(x) + k1 * total) / (len(x) + k1) for h, x in hosts.items()}
    k2 = moments([(len(x), sum(x), host_mean[h]) for (h, _), x in paths.items()])
    for d, h, p, own, evidence in rows:
        x = paths[h, p]
        path_mean = (sum(x) - own + k2 * host_mean[h]) / (len(x) - 1 + k2)
        posterior = 1 / (1 + np.exp(-(evidence + np.log(path_mean / (1 - path_mean)))))
        assert np.allclose(got[d], (host_mean[h], path_mean, posterior), atol=1e-9)


def test_quality_words_tell(spark):
    rows = [(k, ("fine words of a good kind " if k % 2 else "cheap pills buy now click ") * 5 + f"w{k}") for k in range(80)]
    docs = spark.createDataFrame([(k, t, "s", "en") for k, t in rows], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    got = {r.doc_id: r.keep for r in op06_quality.judge(docs, labels).collect()}
    assert all(got[k] == bool(k % 2) for k in range(40, 80))


# --- 1


def test_forest_on_held_out_findings(spark):
    from pyspark.ml.feature import VectorAssembler

    docs = read(spark, "documents")
    f = op01_secrets.features(op01_secrets.findings(docs), op01_secrets.dictionary(docs)).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))).cache()
    model = op01_secrets.train(f.where("half = 0"))
    rows = model.transform(VectorAssembler(inputCols=list(op01_secrets.INPUTS), outputCol="vector").transform(f.where("half = 1").withColumnRenamed("label", "truth")))
    n = {(r.truth, int(r.prediction)): r["count"] for r in rows.groupBy("truth", "prediction").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) >= 0.9 and n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.9
    # what the format rules alone would say is another thing
    ruled = {(r.label, r.rule): r["count"] for r in op01_secrets.rule_label(f.withColumnRenamed("label", "truth")).select(F.col("truth").alias("label"), F.coalesce("label", F.lit(0)).alias("rule")).groupBy("label", "rule").count().collect()}
    assert ruled.get((0, 1), 0) > n.get((0, 1), 0) or ruled.get((1, 0), 0) > n.get((1, 0), 0)
    f.unpersist()


def test_forest_takes_back_what_the_rules_flag(spark):
    docs = read(spark, "documents").select("doc_id", "text", "source")
    more = spark.createDataFrame([(-1, 'api_key = "example-token-1234567890" in the manual', "docs/a"), (-2, "see commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff for it", "docs/b")], "doc_id long, text string, source string")
    got = {(r.doc_id, r.is_secret) for r in op01_secrets.judge(docs.unionByName(more)).where("doc_id < 0").collect()}
    assert got == {(-1, False), (-2, False)}
    f = op01_secrets.features(op01_secrets.candidates(more), [])
    assert op01_secrets.rule_label(f).where("label = 1").count() == 1


def test_secrets(spark, odd, none):
    got = {r.doc_id: r for r in op01_secrets.query(odd).collect()}
    assert set(got) == {d for d, _ in TEXTS} and got[12].n_secrets == 1 and got[1].n_candidates == 0 and got[16].n_candidates == 1
    red = op01_secrets.redact(odd)
    assert red.columns == odd.columns and red.count() == len(TEXTS)
    assert {r.text for r in red.where("doc_id = 12").collect()} == {'token = "[SECRET]" here'}
    assert sorted(map(repr, (r.text for r in red.where("doc_id <> 12 or doc_id is null").collect()))) == sorted(repr(t) for d, t in TEXTS if d != 12)
    assert op01_secrets.query(none).count() == 0 and op01_secrets.redact(none).count() == 0
    docs = read(spark, "documents")
    hits = {(r.doc_id, r.value) for r in op01_secrets.judge(docs).where("is_secret").collect()}
    assert hits == planted_secrets(docs)


def planted_secrets(docs):
    return {(r.doc_id, v) for r in docs.collect() for v in re.findall(r'token = "([0-9a-f]{40})"|password=([0-9a-f]{18})|(AKIA[0-9A-Z]{16})', r.text) for v in v if v}


def test_secrets_of_more_documents(spark):
    """Precision and recall of 0.95 on the tables of the next size; a name with digits in a path is no secret."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    more = spark.createDataFrame([(-1, "see src/main/java/org/apache/Example1Test2 for it", "docs/a"), (-2, "ERSCHSCHBERBERTZ und mehr", "docs/b")], "doc_id long, text string, source string")
    hits = {(r.doc_id, r.value) for r in op01_secrets.judge(docs.unionByName(more)).where("is_secret").collect()}
    planted = planted_secrets(docs)
    assert len(hits & planted) >= 0.95 * len(hits) and len(hits & planted) >= 0.95 * len(planted)
    assert not any(d < 0 for d, _ in hits)


def test_forest_tells_a_form_that_it_was_not_trained_with(spark):
    """Keys of one form are held out as a whole; the forest finds most of them behind other evidence."""
    from pyspark.ml.feature import VectorAssembler

    docs = read(spark, "documents")
    f = op01_secrets.features(op01_secrets.findings(docs), op01_secrets.dictionary(docs)).cache()
    own = F.col("value").startswith("ghp_")
    rows = op01_secrets.train(f.where(~own)).transform(VectorAssembler(inputCols=list(op01_secrets.INPUTS), outputCol="vector").transform(f.where(own)))
    n = rows.agg(F.count("*").alias("n"), F.sum(F.col("prediction")).alias("found")).first()
    assert n.n > 100 and n.found / n.n >= 0.8
    f.unpersist()


# --- 7


def brute_chat(rows):
    convs = defaultdict(list)
    for c, n, r, t in rows:
        convs[c].append((n, r or "unknown", t or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x))
        safe = lambda x: x.replace("\\", "\\\\").replace("<|", "<\\|")
        turns = [(n, safe(r.replace("\n", " ").replace("\r", " ")), safe(t)) for n, r, t in turns]
        for who in {r for _, r, _ in turns} - {"system"}:
            text, mask = "", []
            for _, r, t in turns:
                text += "<|start|>" + ("assistant" if r == who else "system" if r == "system" else f"user name={r}") + "\n"
                if r == who:
                    mask.append((len(text), len(text) + len(t) + len("<|end|>\n")))
                text += t + "<|end|>\n"
            out.append((c, who, text, mask))
    return sorted(out, key=repr)


def chat(df):
    """The pieces put together again."""
    whole = defaultdict(list)
    for r in op07_perspectives.rotate(df).collect():
        whole[r.conv_id, r.perspective].append((r.block, r.piece, r.start, r.text, [(m.start + r.start, m.end + r.start) for m in r["mask"]]))
    return sorted(((c, who, "".join(x[3] for x in sorted(p)), [m for x in sorted(p) for m in x[4]]) for (c, who), p in whole.items()), key=repr)


def test_perspectives(spark, monkeypatch):
    rows = [(1, 0, "user", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, 200, None, "late"), (2, None, "a", ""), (None, 3, "a", "x"), (1, 1, "ann", "tie"), (1, 0, "system", "Be brief."), (4, 0, "system", "alone"), (5, 1, "a<|end|>\nb", "x<|end|>\\<|start|>assistant"), (5, 0, "c\\", "<\\|")] + [(3, k % 7, "abc"[k % 3], f"t{k}") for k in range(30)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, k string")
    assert chat(df) == brute_chat(rows)
    monkeypatch.setattr(op07_perspectives, "PIECE", 4)
    monkeypatch.setattr(op07_perspectives, "TURNS", 3)
    monkeypatch.setattr(op07_perspectives, "SPAN", 2)
    assert chat(df) == brute_chat(rows)
    assert op07_perspectives.query(df.limit(0)).count() == 0


# --- 8


def brute_links(rows):
    def shingles(t):
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [(d, shingles(t)) for d, t in rows]
    top = list(range(len(sets)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    index = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        both = defaultdict(int)
        for g in s:
            for j in index[g]:
                both[j] += 1
            index[g].append(k)
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((find(j), find(k)))
                top[b] = a
    least = defaultdict(list)
    for k, (d, _) in enumerate(sets):
        least[find(k)].append(d)
    first = lambda ids: min((d for d in ids if d is not None), default=None)
    return sorted(repr((d, len(s), first(least[find(k)]))) for k, (d, s) in enumerate(sets))


def test_components_of_few_edges_take_no_round(spark, monkeypatch):
    from varspan.llm import common

    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(-rng.randrange(1, 90), -rng.randrange(1, 90)) for _ in range(60)] + [(5, 5), (None, 3)]
    least = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in least:
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    found, plain, tables = [], common.written, []
    monkeypatch.setattr(common, "written", lambda df: tables.append(1) or plain(df))
    for most, parts in ((common.EDGES, 1), (3, 4)):  # all in one step; steps of three edges
        monkeypatch.setattr(common, "EDGES", most)
        df = spark.createDataFrame(edges, "a long, b long").repartition(parts)
        assert dict(common.components(df).collect()) == least
        found.append(len(tables))
    assert found[0] == 1


def test_components_of_few_edges_are_one_step_however_many_partitions(spark, monkeypatch):
    from varspan.llm import common

    plain, tables = common.written, []
    monkeypatch.setattr(common, "written", lambda df: tables.append(1) or plain(df))
    chain = [(k, k + 1) for k in range(80)]
    random.Random(5).shuffle(chain)
    few = [(a % 12, b % 12) for a, b in chain * 2]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(chain, "a long, b long").repartition(7)
        assert dict(common.components(df).collect()) == dict.fromkeys(range(81), 0)
        assert len(tables) == 1
        monkeypatch.setattr(common, "EDGES", 20)  # many edges of few nodes: few are left after the tasks' own steps
        df = spark.createDataFrame(few, "a long, b long").repartition(7)
        assert sorted(common.components(df).collect()) == [(k, 0) for k in range(12)]
        none = spark.createDataFrame([(3, 3), (None, 4)], "a long, b long")
        assert common.components(none).collect() == []
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tasks_collect_no_garbage(monkeypatch):
    import pyarrow as pa

    from varspan.llm import common

    calls = []
    monkeypatch.setattr(common.gc, "collect", lambda: calls.append(1))
    for n, want in ((10, 0), (common.TIDY_BYTES // 8, 1)):
        b = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], ["x"])
        assert [x.num_rows for x in common.tidied(lambda batches: batches)([b])] == [n]
        assert len(calls) == want


def links(df):
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in op08_setjoin.query(df).collect())


def test_set_join(spark, odd, none):
    assert links(odd) == brute_links(TEXTS)
    assert links(none) == []
    docs = read(spark, "documents")
    assert links(docs) == brute_links([(r.doc_id, r.text) for r in docs.collect()])


def test_rows_without_an_id_link_and_bridge(spark):
    w = [f"w{k}" for k in range(100)]
    near = lambda n: " ".join(["x"] * n + w[n:])  # noqa: E731  neighbours by five words link, those by ten don't
    rows = [(1, near(0)), (None, near(5)), (3, near(10)), (None, "a lone text without any id at all"), (None, near(5)), (7, "another text that is on its own here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert links(df) == brute_links(rows)
    assert {r.component_id for r in op08_setjoin.query(df).where("doc_id = 3").collect()} == {1}
    assert op08_setjoin.keep_one(df).count() == 5


def test_set_join_loses_no_link_of_every_hundredth_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op08_setjoin.query(docs).collect()}
    sets = {}
    for r in docs.collect():
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (r.text or "").encode()).split()
        sets[r.doc_id] = {hash(tuple(w[k : k + 5])) for k in range(max(1, len(w) - 4))} if w else set()
    assert all(got[d][0] == len(s) for d, s in sets.items())
    index = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            index[g].append(d)
    linked = 0
    for d in (d for d in sets if d % 100 == 0):
        both = defaultdict(int)
        for g in sets[d]:
            for j in index[g]:
                both[j] += 1
        near = [j for j, n in both.items() if j != d and 100 * n >= 80 * (len(sets[d]) + len(sets[j]) - n)]
        linked += len(near)
        assert all(got[j][1] == got[d][1] for j in near)
    assert linked


def test_set_join_small_sets_and_chains(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(300):
        base = [f"v{x}" for x in np.random.default_rng(k % 12).integers(0, 40, 8 + k % 12)]
        for _ in range(rng.integers(0, 3)):
            base[rng.integers(0, len(base))] = f"v{rng.integers(0, 40)}"
        rows.append((k, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_links(rows)
    for limit in (0, 6, 24):
        monkeypatch.setattr(op08_setjoin, "boundary", lambda sets, n=limit: n)
        assert links(df) == want
    monkeypatch.setattr(op08_setjoin, "PIVOT_ROUNDS", 1)
    assert links(df) == want


# --- 9


def test_packing(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (odd, read(spark, "documents")):
        rows = df.select("doc_id", "text").collect()
        ids = defaultdict(list)
        for r in rows:
            ids[r.doc_id].append([*t.encode(r.text or "", add_special_tokens=False).ids, 0])
        got = op09_packing.query(df).collect()
        seen = defaultdict(set)
        for r in got:
            assert 0 < r.length and r.offset + r.length <= 1024
            own = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
            assert own
            seen[r.sequence_id] |= {(r.offset, r.length)}
        assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
        for n, (_, parts) in enumerate(sorted(seen.items())):
            at = 0
            for o, m in sorted(parts):
                assert o == at
                at += m
            assert at == 1024 or n == len(seen) - 1
        assert sorted(seen) == list(range(len(seen)))
    assert op09_packing.query(none).count() == 0


# --- 10


def test_media(spark, odd, none):
    got = op10_media.query(odd).collect()
    assert len(got) == len(TEXTS) and op10_media.query(none).count() == 0
    want = []
    for d, t in TEXTS:
        b = (t or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        f = io.BytesIO()
        with wave.open(f, "wb") as w:
            w.setparams((1, 1, op10_media.RATE, 0, "NONE", ""))
            w.writeframes(p)
        want.append(repr((d, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(f.getvalue()), hashlib.sha256(f.getvalue()).hexdigest())))
    assert sorted(repr(tuple(r[:7])) for r in got) == sorted(want)
    by_text = defaultdict(set)
    for r in got:
        by_text[r.payload_sha256].add(r.feature)
    assert all(len(x) == 1 for x in by_text.values())


def brute_pairs(payload):
    """(time, code) of all pairs by a plain transform of each frame."""
    x = np.frombuffer(payload, np.uint8).astype(np.float32)
    n = max(1, -(-(len(x) - op10_media.FRAME) // op10_media.HOP) + 1)
    x = np.concatenate([x, np.zeros((n - 1) * op10_media.HOP + op10_media.FRAME - len(x), np.float32)])
    peaks = []
    for k in range(n):
        f = x[k * op10_media.HOP :][: op10_media.FRAME]
        m = np.abs(np.fft.rfft((f - f.mean()) * np.hanning(op10_media.FRAME).astype(np.float32))).astype(np.float32)
        m[0] = 0
        tops = [i for i in range(1, len(m)) if m[i] > m[i - 1] and (i + 1 == len(m) or m[i] >= m[i + 1]) and m[i] >= op10_media.FLOOR]
        peaks.append(sorted(tops, key=lambda i: (-m[i], i))[: op10_media.PEAKS])
    return sorted((k, a << 10 | b << 2 | gap) for k in range(n) for gap in range(1, op10_media.AHEAD + 1) if k + gap < n for a in peaks[k] for b in peaks[k + gap])


def test_media_pairs(spark):
    texts = [P, COPY, "short", "x" * 3000, "ab" * 700, "".join(chr(33 + k * k % 90) for k in range(5000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op10_media.fingerprint(op10_media.store_wav(df)).collect():
        assert sorted(zip(r.times, r.codes, strict=True)) == brute_pairs(bytes(r.payload))


def test_media_peaks_of_a_tone():
    k = 20
    x = 128 + 100 * np.sin(2 * np.pi * k * np.arange(4096) / op10_media.FRAME)
    assert set(op10_media.peaks(x.astype(np.float32))[:-1, 0]) == {k}


# --- the pipeline


def test_pipeline(spark, odd):
    docs = read(spark, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "secrets", "pack"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "pack":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept[name] = (docs, out)
        docs = spark.createDataFrame(out.collect(), out.schema)
    before, after = kept["near_duplicates"]
    groups = {re.search(r"\((\w+), \d+, (\w+)\)", x)[2] for x in brute_links([(r.doc_id, r.text) for r in before.collect()])}
    assert {str(r.doc_id) for r in after.collect()} == groups
    items = [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]
    before, after = kept["decontaminate"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not brute_hits(r.text, items)[-1]}
    before, after = kept["secrets"]
    assert after.count() == before.count() and not [r for r in after.collect() if re.search(r'token = "[0-9a-f]{40}"|AKIA[0-9A-Z]{16}', r.text)]
    assert all(r.n_chars == len(r.text) for r in after.collect())
    left = {name: sorted((r[0] for r in stage(spark, odd, SMALL).select("doc_id").collect()), key=repr) for name, stage in corpus_pipeline.STAGES}
    every = sorted((d for d, _ in TEXTS), key=repr)
    assert left["quality"] == left["secrets"] == left["decontaminate"] == every
    import ast

    assert left["near_duplicates"] == sorted((d for d, _, c in map(ast.literal_eval, brute_links(TEXTS)) if d is None or c == d), key=repr)
    assert set(left["pack"]) == set(every)
    assert all(stage(spark, odd.limit(0), SMALL).count() == 0 for _, stage in corpus_pipeline.STAGES)
    before, after = kept["quality"]
    labels = read(spark, "labels")
    good = {r.doc_id for r in op06_quality.judge(before, labels).where("keep").collect()}
    assert {r.doc_id for r in after.collect()} == good
    before, after = kept["pack"]
    assert after.agg(F.sum("length")).first()[0] == op09_packing.query(before).agg(F.sum("length")).first()[0]


def test_oracles(spark):
    from harness import compare, connect

    con = connect(SMALL)
    for name, sql in queries.ORACLES.items():
        assert compare(spark, con, name, queries.QUERIES[name], sql, SMALL) == []


def test_rounds_of_trust_write_few_files(spark):
    """A small graph is handed on by one task, however many partitions a shuffle has."""
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    edges = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1.0) for k in range(100)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("h0", 1, 0), ("h90", 0, 1)], "host string, n_allow long, n_block long")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        ranks = op05_url_trust.propagate(edges, seeds)
        assert len(ranks.inputFiles()) == 1
        assert ranks.count() > 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
