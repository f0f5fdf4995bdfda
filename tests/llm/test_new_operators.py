"""Operators 11 to 13 against brute force, on odd rows and on the smallest tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from varspan.llm import op11_langid, op12_structure, op13_variants


def read(spark, name, sf=SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- 11

LANGS = {"en": "the quick brown fox jumps over the lazy dog and then it goes on ", "fr": "le renard brun saute par dessus le chien paresseux et puis il dort ", "de": "der schnelle braune fuchs springt über den faulen hund und schläft "}


def texts(n, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(n):
        lang = ("en", "fr", "de")[k % 3]
        words = LANGS[lang].split()
        rows.append((k, " ".join(rng.choices(words, k=rng.randrange(8, 60))), lang))
    return rows


def test_language_is_the_one_with_the_smallest_code(spark):
    rows = [*texts(120), (500, None, "en"), (501, "", "fr"), (502, "12 -- 34 !", "de"), (503, "THE LAZY DOG goes ON and then it jumps over THE fox", None), (None, LANGS["fr"] * 3, "fr"), (504, LANGS["de"] * 5000, "de"), (7, LANGS["en"], "en"), (7, LANGS["en"], "en")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, h string, held int").repartition(4)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 4 == 2
    model = op11_langid.fit(docs.where(~op11_langid.held_out(F.col("doc_id"))))
    # the dictionary: every distinct piece of the texts that aren't held out
    pieces = defaultdict(set)
    for d, t, lang in rows:
        if lang and t and not held(d):
            b = t.lower().encode()
            pieces[lang] |= {b[i : i + op11_langid.PIECE] for i in range(0, len(b), op11_langid.PIECE)}
    for m in model:
        assert len(m.dictionary) == sum(map(len, pieces[m.name])) or len(pieces[m.name]) > op11_langid.PIECES
        assert all(p in m.dictionary for p in pieces[m.name]) or len(pieces[m.name]) > op11_langid.PIECES
    encoders = op11_langid._encoders(model)
    got = sorted((tuple(r) for r in op11_langid.query(docs).collect()), key=repr)
    want = []
    for d, t, _ in rows:
        if not t or not any(c.isalpha() for c in t):
            want.append((d, held(d), "und", 0.0, None, None, None, False))
            continue
        size = op11_langid.code_sizes(t.lower().encode(), encoders)
        order = sorted(range(len(model)), key=lambda k: (size[k], -model[k].texts, model[k].name))
        a, b = order[:2]
        share = 1 / sum(2.0 ** -min(8 * (s - size[a]), 1000) for s in size)
        want.append((d, held(d), model[a].name, share, model[b].name, size[a], size[b], size[b] - size[a] < max(op11_langid.MARGIN_BYTES, op11_langid.MARGIN * size[b])))
    assert got == sorted(want, key=repr)
    by = {r[0]: r[2] for r in got}
    assert by[503] == "en" and by[504] == "de"


def test_language_of_held_out_texts(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    got = op11_langid.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    sure = [r for r in got if not r.rejected]
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert sum(r.lang_pred == r.lang for r in sure) / len(sure) > 0.985 and len(sure) > 0.9 * len(got)


def test_language_without_labels_or_rows(spark):
    schema = "doc_id string, text string, lang string"
    assert op11_langid.query(spark.createDataFrame([], schema)).count() == 0
    none = op11_langid.query(spark.createDataFrame([("a", "some words", None)], schema)).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)
    one = op11_langid.query(spark.createDataFrame([("a", "some words", "en"), ("b", "others", None)], schema)).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in one} == {("en", 1.0, False)}


def test_language_learns_from_no_held_out_row(spark):
    docs = spark.createDataFrame(texts(90), "doc_id long, text string, lang string")
    other = docs.withColumn("lang", F.when(op11_langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    rows = lambda d: sorted(map(tuple, op11_langid.query(d).collect()))
    assert rows(docs) == rows(other)


# --- 12

SPACE = " \t\n\v\f\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        c, t, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        h = zlib.crc32(f"{c}:{t}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def brute_repair(rows):
    """rows of one conversation after damage: all edits by search over (row, state), strings and costs plain."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        stripped = text.strip(SPACE)
        faults.append("b" if not stripped else "d" if (role, text) in seen else "t" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(k, state, inserts):
        """(cost, letters, repaired) of all that is left."""
        options = [(0, "", ())] if k == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in step:
                    c, s, r = best(k, step[state, role[0]], inserts + 1)
                    options.append((c + 5, "I" + s, ((role, ""), *r)))
        if k < len(rows):
            role, text = rows[k][2:]
            c, s, r = best(k + 1, state, 0)
            options.append((c + 2, "D" + s, r))
            if faults[k] not in ("b", "d"):
                more = 5 if faults[k] == "t" else 0
                if (state, role[:1]) in step:
                    c, s, r = best(k + 1, step[state, role[:1]], 0)
                    options.append((c + more, "K" + s, ((role, text), *r)))
                for new in ("user", "assistant"):
                    if (state, new[0]) in step:
                        c, s, r = best(k + 1, step[state, new[0]], 0)
                        options.append((c + 1 + more, "R" + s, ((new, text), *r)))
        return min(options, default=(10**9, "", ()))

    cost, audit, repaired = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    n = Counter(faults)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()


def structure(df):
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in cols) for r in op12_structure.query(df).collect()}


def brute_structure(rows):
    convs = defaultdict(list)
    for r in brute_damage(rows):
        convs[r[0]].append(r)
    return {c: brute_repair(convs[c]) for c in {r[0] for r in rows}}


CONV = "conv_id long, turn long, role string, text string, rank long, conv string, items string, idx long"


def odd_conversations(seed=4):
    rng, rows = random.Random(seed), []
    for conv in [*range(60), None]:
        for t in range(rng.randrange(1, 14)):
            turn = rng.choice([t, t, t + 1, None]) if rng.random() < 0.3 else t
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", "", "uncle"]), rng.choice(["Hi.", "what?", "no end", " ", "", None, "well done! ", "ä" * 50 + ".", f"text {rng.random()}."])))
    return rows


def test_structure(spark):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1, "c", "i", 2) for r in rows], CONV).repartition(5)
    assert structure(df) == brute_structure(rows)
    real = [tuple(r) for r in read(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert structure(read(spark, "conversations")) == brute_structure(real)
    assert structure(spark.createDataFrame([], CONV)) == {}


def test_structure_over_many_blocks(spark, monkeypatch):
    import sys

    monkeypatch.setattr(op12_structure, "SPAN", 3)  # blocks of blocks, and 30 at the top
    sys.setrecursionlimit(10_000)
    rng = random.Random(9)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", f"n {t}.", f"m {t}", ""])) for t in range(270)]
    rows += [(6, 0, "user", "Hello there.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert structure(df) == brute_structure(rows)


def test_structure_of_a_dropped_conversation(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert structure(df) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_structure_weights_are_least_costs_then_letters():
    assert op12_structure.field_letters(op12_structure.field_code("IIK")) == "IIK"
    assert op12_structure.field_code("D") < op12_structure.field_code("ID") < op12_structure.field_code("IK") < op12_structure.field_code("K") < op12_structure.field_code("R")


# --- 13


def brute_words(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute_near(words):
    """Pairs one edit apart, by the words with a letter left out and, of equal length, the place where they differ."""
    out = defaultdict(set)
    gone, hole = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gone[w[:i] + w[i + 1 :]].add(w)
            hole[w[:i], w[i + 1 :]].add(w)
    for w in words:
        for v in gone.get(w, ()):
            out[w].add(v)
            out[v].add(w)
    for group in hole.values():
        for w in group:
            out[w] |= group - {w}
    return out


def brute_variants(words):
    near = brute_near(words)
    form = {}
    for w, n in words.items():
        if near[w]:
            v = min(near[w], key=lambda x: (-words[x], x))
            if words[v] >= 5 * n:
                form[w] = v
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words.get(form.get(w)))
    return out


def variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants(spark):
    docs = read(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = variants(op13_variants.query(docs))
    assert got == brute_variants(brute_words(rows)) and any(v[0] for v in got.values())


@pytest.mark.parametrize("shard, queries", [(1 << 15, 1 << 16), (7, 5)])
def test_near_words_of_any_shape(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(op13_variants, "SHARD", shard)
    monkeypatch.setattr(op13_variants, "QUERIES", queries)
    rng, words = random.Random(2), {}
    for _ in range(160):
        w = "".join(rng.choices("abé", k=rng.randrange(6, 10)))
        words[w] = rng.choice([5, 6, 25, 30, 130, 700])
    for w in ("hothothot", "hothothots", "hothotho", "x" * 400, "x" * 401, "x" * 399 + "y", "ÿÿÿÿÿÿ", "ÿÿÿÿÿ÷"):
        words[w] = 5
    words |= {f"prefix{a}{b}": 5 + (a == "q") * 40 for a in "qrst" for b in "uvwx"}
    got = variants(op13_variants.group(spark.createDataFrame(sorted(words.items()), "word string, n long")))
    assert got == brute_variants(words)


def test_variants_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Colour colour COLOUR " * 20), (4, "color color color color color colors " * 1), (None, "colors colors colors colors ÜnderÀ Éclairs éclairs ×÷×÷×÷"), (5, "abcde " * 50), (6, "z" * 20_000 + " " + "KelvinK kelvin")]
    rows += [(7, "éclairs éclairs éclairs")] * 3
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert variants(op13_variants.query(df)) == brute_variants(brute_words(rows))
    assert variants(op13_variants.query(df.limit(0))) == {}


def test_roots_follow_chains(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625}
    got = variants(op13_variants.group(spark.createDataFrame(sorted(words.items()), "word string, n long")))
    assert got == brute_variants(words) and got["aaaaaa"][1] == "abbbbb"
