r"""Operator 1, secret scans: a random forest over token-like candidates removes false positives; DataFrame functions alone.

A candidate is a run of 16 or more characters of `[A-Za-z0-9+/_-]` in a white-space word, with further runs after dots and with
`=` at its end. Features: length; transitions between lower case, capitals and digits; shares of digits, capitals and
distinct characters; dictionary coverage, the share of its triples that are common in the words of all documents;
depth and test-like names of the path; names of keys, names of digests and ids, an assignment or a quote in the word
itself and the two words before, and the word after being an ordinary one.

The forest is trained from labelled findings: given ones, or those of findings(), which are planted: up to `SEEDS` documents, taken
by a hash, lend their paths, digests and the words of their first SEED_LETTERS letters. A planted key is a secret wherever it stands, also in prose; a
digest in the place of a checksum, commit or id, a name made of words and a placeholder are none, also behind the
name of a key. So neither form nor place alone tells the label. With too few documents for both labels, format rules decide.

Defined results: null and empty texts have no candidates; a null path has depth 0; rows of one doc_id are counted together;
secrets of fewer than 16 characters or over several words are no candidates; without labelled findings of both kinds no
forest can be trained and a rule's label decides; a score of exactly THRESHOLD is no secret; other columns are kept out of scan() and pass through redact().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import labelled_sample, written

#: Labelled findings of each kind for training, at most; documents that planted findings are made of, and findings for each.
MOST_LABELLED, SEEDS, EACH = 10_000, 400, 48
#: Letters of such a document that words are taken from; documents that are scanned are taken whole.
SEED_LETTERS = 4000
TREES, DEPTH, SEED, THRESHOLD = 20, 8, 7, 0.5
#: Share of all triples of words that the common ones make up.
COMMON = 0.95
MASK = "[SECRET]"
_CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}(?:\.[A-Za-z0-9+/_\-]{4,})*(?:={1,2}(?![A-Za-z0-9+/]))?"
_KEYS = r"(?i)(token|secret|passw|pwd|api_?key|access_?key|auth|bearer|credential)"
_DIGESTS = r"(?i)(commit|sha|md5|digest|checksum|hash|etag|uuid|guid|(^|[^a-z])id[\s:=\"']|https?:)"
_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})$"
INPUTS = ("length", "transitions", "digits", "capitals", "distinct", "coverage", "path_depth", "path_test", "key_name", "digest_name", "assigned", "quoted", "next_plain")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row a candidate: doc_id, path, word (its index), value, and the words around it."""

    def around(words: Column) -> Column:
        long = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: (F.length(x["w"]) >= 16) & x["w"].rlike(r"[A-Za-z0-9+/_\-]{16}"))
        get = lambda i: F.when(i >= 0, F.get(words, i))
        return F.transform(long, lambda x: F.struct(x["w"].alias("w"), x["i"].alias("word"), get(x["i"] - 1).alias("prev"), get(x["i"] - 2).alias("prev2"), get(x["i"] + 1).alias("next")))

    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"\s+")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.explode(F.element_at(F.transform(F.array(words), around), 1)).alias("c")).select("doc_id", "path", "c.*")
    return rows.select("doc_id", "path", "word", "w", "prev", "prev2", "next", F.explode(F.regexp_extract_all("w", F.lit(_CANDIDATE), 0)).alias("value"))


def _triples(text) -> Column:
    """All letter triples of a text, overlapping, in one pass over it."""
    return F.regexp_extract_all(text, F.lit("(?=(...))"), 1)


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The letter triples that make up COMMON of all triples of the words of all documents: 26 ** 3 at most. Words are counted first, so
    that each distinct one is taken apart once."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z]+")).alias("w")).where("length(w) between 3 and 15").groupBy("w").count()
    triples = words.select(F.explode(_triples("w")).alias("t"), "count").groupBy("t").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "t").collect()
    total, kept, out = sum(r.n for r in triples), 0, []
    for r in triples:
        if kept >= COMMON * total:
            break
        kept += r.n
        out.append(r.t)
    return out


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Planted findings with `label`: doc_id, path, word, w, prev, prev2, next, value as candidates() has them. Bounded by SEEDS and EACH."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    seeds = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(path_col).cast("string").alias("path"), text.alias("text"))
    seeds = written(labelled_sample(seeds, SEEDS, "doc_id", "path", "text").withColumn("text", F.substring("text", 1, SEED_LETTERS)))  # SEEDS rows
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: F.length(w).between(3, 12))
    words = F.when(F.size(words) >= 4, words).otherwise(F.array(*[F.lit(x) for x in ("first", "second", "third", "fourth")]))
    d = seeds.select("doc_id", "path", words.alias("ws"), F.explode(F.sequence(F.lit(0), F.lit(EACH - 1))).alias("j"))
    d = d.withColumn("h", F.sha2(F.concat_ws(":", F.coalesce("doc_id", F.lit("")), F.col("j").cast("string"), F.array_join("ws", " ")), 256))
    d = d.withColumn("code", F.translate(F.base64(F.unhex(F.concat("h", F.sha2("h", 256)))), "\r\n", ""))
    part = lambda c, n: F.substring(c, 1, n)
    plain = lambda c, n: part(F.translate(c, "+/=", "xyz"), n)
    pick = lambda options, at: F.element_at(F.array(*options), (F.pmod(F.conv(F.substring("h", at, 6), 16, 10).cast("long"), F.lit(len(options))) + 1).cast("int"))
    own = lambda k: F.element_at("ws", (F.pmod(F.conv(F.substring("h", 9 + k, 6), 16, 10).cast("long"), F.size("ws")) + 1).cast("int"))
    near = lambda a, b, c: F.struct(a.alias("prev2"), b.alias("prev"), F.lit(c).alias("head"))
    lit, uuid = F.lit, F.concat_ws("-", part("h", 8), F.substring("h", 9, 4), F.substring("h", 13, 4), F.substring("h", 17, 4), F.substring("h", 21, 12))
    prose = [near(own(1), own(2), ""), near(own(1), own(2), '"')]
    key = [near(lit("token"), lit("="), '"'), near(own(1), own(2), "password="), near(lit("api_key"), lit(":"), '"'), near(lit("Authorization:"), lit("Bearer"), ""), near(own(1), lit("export"), "AWS_SECRET_ACCESS_KEY="), near(own(1), lit("secret:"), ""), near(own(1), lit("passwd"), "'")]
    digest = [near(own(1), lit("commit"), ""), near(own(1), own(2), "sha256:"), near(lit("md5"), lit("="), ""), near(lit("etag"), lit(":"), '"'), near(lit("request"), lit("id:"), ""), near(own(1), lit("checksum"), ""), near(own(1), lit("uuid="), "")]
    formats = [F.concat(lit("AKIA"), F.translate(F.upper(part("h", 16)), "0189", "GHIJ")), F.concat(lit("ghp_"), plain("code", 36)), F.concat(lit("sk_live_"), plain("code", 24))]
    random = [part("h", 40), part("h", 18), part("h", 32), part("code", 40), F.concat(part("code", 43), lit("=")), F.concat(lit("eyJ"), plain("code", 17), lit("."), F.substring(F.translate("code", "+/=", "xyz"), 20, 40))]
    sums = [part("h", 40), part("h", 32), F.col("h"), uuid]
    names = [F.concat_ws(sep, own(1), own(2), own(3), own(4)) for sep in ("_", "-", "/")] + [F.concat(own(1), F.initcap(own(2)), F.initcap(own(3)), F.initcap(own(4))), F.concat(own(1), own(2), own(3), own(4))]
    names += [F.upper(F.concat(own(1), own(2), own(3), own(4))), F.concat(F.concat_ws("/", lit("src"), own(1), own(2), F.initcap(own(3))), part(F.translate("h", "abcdef", "123456"), 1), F.initcap(own(4)))]
    holders = [lit("your_api_key_goes_here"), lit("xxxxxxxxxxxxxxxxxxxxxxxx"), lit("0000000000000000000000"), lit("example-token-1234567890"), lit("changeme_changeme_changeme"), lit("1234567890123456")]
    kinds = [(1, random, key), (1, random, key), (1, formats, key + prose + digest), (0, sums, digest), (0, names, key + prose + digest), (0, holders, key + prose)]
    case = lambda f: F.element_at(F.array(*[f(k) for k in kinds]), F.pmod(F.col("j"), F.lit(len(kinds))) + 1)
    d = d.select("doc_id", "path", "h", "j", "ws", F.struct(case(lambda k: F.lit(k[0])).alias("label"), case(lambda k: pick(k[1], 1)).alias("value"), case(lambda k: pick(k[2], 20)).alias("near")).alias("f"), own(3).alias("next"))
    d = d.select("doc_id", "path", F.col("j").alias("word"), "f.label", "f.value", "f.near.*", "next").where("length(value) >= 16")
    tail = F.when(F.col("head").endswith('"') | F.col("head").endswith("'"), F.substring("head", -1, 1)).otherwise(F.lit(""))
    return d.select("doc_id", "path", "word", F.concat("head", "value", tail).alias("w"), "prev", "prev2", "next", "value", "label")


def features(found: DataFrame, triples: list[str]) -> DataFrame:
    v, n = F.col("value"), F.length("value").cast("double")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    flag = lambda c: c.cast("double")
    head = F.expr("substring_index(w, value, 1)")
    before = F.concat_ws(" ", text("prev2"), text("prev"), head)
    low = F.lower("value")
    known = F.filter(_triples(low), lambda t: t.isin(triples) if triples else F.lit(False))
    return found.withColumns({
        "length": n,
        "transitions": F.regexp_count(v, F.lit("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])")) / n,
        "digits": F.regexp_count(v, F.lit("[0-9]")) / n,
        "capitals": F.regexp_count(v, F.lit("[A-Z]")) / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "coverage": F.size(known) / (n - 2),
        "path_depth": F.regexp_count(text("path"), F.lit("/")).cast("double"),
        "path_test": flag(text("path").rlike("(?i)test|example|sample|mock|fixture")),
        "key_name": flag(before.rlike(_KEYS)),
        "digest_name": flag(before.rlike(_DIGESTS)),
        "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(head.rlike("[\"'`]$")),
        "next_plain": flag(text("next").rlike("^[a-z]+[.,]?$")),
    })


def rule_label(f: DataFrame) -> DataFrame:
    """Adds `label`: 1 secret, 0 none, null where the format rules can't tell."""
    secret = F.col("value").rlike(_FORMATS) | ((F.col("key_name") > 0) & (F.col("assigned") > 0) & (F.col("digits") > 0))
    none = (F.col("digits") == 0) | (F.col("digits") == 1)
    return f.withColumn("label", F.when(secret, F.lit(1)).when(none, F.lit(0)))


def train(labelled: DataFrame):
    """A forest from findings with features and `label`, or None without both labels. At most MOST_LABELLED of each kind."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    order = F.xxhash64("doc_id", "word", "value")
    kinds = [labelled.where(F.col("label") == k).select(*[F.col(c).cast("double").alias(c) for c in INPUTS], F.lit(float(k)).alias("label"), order.alias("h")).orderBy("h", *INPUTS).limit(MOST_LABELLED) for k in (0, 1)]
    sample = written(kinds[0].unionByName(kinds[1]).coalesce(1).sortWithinPartitions("h", "label"))
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(INPUTS), outputCol="vector").transform(sample)
    return RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def judge(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All candidates with score and is_secret: doc_id, path, word, value, score, is_secret. labelled: findings as candidates() has them, with
    `label` 1 or 0."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    found, triples = written(candidates(docs, id_col, text_col, path_col)), dictionary(docs, text_col)
    f = features(found, triples)
    model = train(features(findings(docs, id_col, text_col, path_col) if labelled is None else labelled, triples))
    if model is None:
        scored = rule_label(f).withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=list(INPUTS), outputCol="vector").transform(f)
        scored = model.transform(vectors).withColumn("score", F.get(vector_to_array("probability"), 1))
    return scored.select("doc_id", "path", "word", "value", "score", (F.col("score") > THRESHOLD).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Per doc_id: candidates, secrets, the word indexes of the secrets, and the highest score."""
    hits = judge(docs, labelled, id_col, text_col, path_col)
    secret = F.when(F.col("is_secret"), F.col("word"))
    # a document's secrets are as bounded as its text
    by_doc = hits.groupBy("doc_id").agg(F.count("*").alias("n_candidates"), F.count(secret).alias("n_secrets"), F.array_join(F.array_sort(F.collect_list(secret)), ",").alias("secret_words"), F.max("score").alias("best"))
    ids = docs.select(F.col(id_col).alias("i")).distinct()
    zero = F.lit(0).cast("long")
    return ids.join(by_doc, F.col("i").eqNullSafe(F.col("doc_id")), "left").select(F.col("i").alias("doc_id"), F.coalesce("n_candidates", zero).alias("n_candidates"), F.coalesce("n_secrets", zero).alias("n_secrets"), F.coalesce("secret_words", F.lit("")).alias("secret_words"), F.coalesce("best", F.lit(0.0)).alias("best"))


def redact(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """docs with all columns; secrets in the text are replaced by MASK."""
    hits = written(judge(docs, labelled, id_col, text_col, path_col).where("is_secret").select(F.col("doc_id").alias("secret_doc"), "value").distinct())
    values = hits.groupBy("secret_doc").agg(F.sort_array(F.collect_list(F.struct(F.length("value").alias("n"), "value")), asc=False).alias("secrets"))
    small = (hits.agg(F.sum(F.length("value") + 32).alias("n")).first().n or 0) <= 32 << 20
    joined = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("i")).join(F.broadcast(values) if small else values, F.col("i").eqNullSafe(F.col("secret_doc")), "left")
    text = F.when(F.col("secrets").isNull(), F.col(f"doc.{text_col}")).otherwise(F.aggregate("secrets", F.col(f"doc.{text_col}"), lambda t, s: F.replace(t, s["value"], F.lit(MASK))))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"doc.{c}").alias(c) for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    return scan(docs)
