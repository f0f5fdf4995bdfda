"""Operator 5, URL filters: rules on host and path, and link-graph propagation for what no rule fits.

Hosts are nodes. An edge goes from a page's host to each host that its html links to, and between a host and its parent
domain, both ways, as they are run together. Personalised PageRank spreads trust from hosts with pages that a rule
allows along the edges, and distrust from hosts with pages that a rule blocks against them, each seed in proportion to its
pages. A host whose distrust is over `ratio` times its trust is blocked. Rounds go on until
LOOK of them change the ranks of each kind by less than TOLERANCE in sum. All steps are grouped sums and joins by host;
edges are dealt out once and stay where they are, so a round shuffles its sums alone; pages of one host meet only as partial counts.

Defined results: a null url, or one without ://, has empty host and path, fits no rule and is allowed unless that empty
host is blocked; null html has no links; repeated rows give repeated rows; other columns are kept out. Of rules of equal
length the one that blocks wins.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import ascii_lower, with_columns_of, written

# Verdict and rule.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Common public suffixes of two labels, under which strangers register names; a single label is one anyway.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk", "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz", "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr",
    "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.tw", "edu.tw", "org.tw", "com.hk", "org.hk", "com.sg", "edu.sg", "com.my", "co.th", "co.id", "com.ph", "com.vn",
    "ac.in", "co.in", "gov.in", "net.in", "org.in", "com.pk", "com.br", "gov.br", "net.br", "org.br", "com.ar", "com.mx", "com.co", "com.pe", "com.tr", "gov.tr", "org.tr",
    "ac.za", "co.za", "org.za", "co.ke", "com.ng", "com.eg", "com.sa", "co.il", "org.il", "com.ua", "com.pl", "net.pl", "org.pl", "com.es", "org.es", "co.at", "or.at",
    "github.io", "gitlab.io", "pages.dev", "web.app", "netlify.app", "vercel.app", "blogspot.com", "wordpress.com", "herokuapp.com", "amazonaws.com", "azurewebsites.net", "appspot.com", "cloudfront.net", "fly.dev", "onrender.com", "readthedocs.io",
)
DAMPING, ROUNDS, RATIO = 0.85, 8, 1.0
#: Summed change of ranks over LOOK rounds, of which each kind has 1 in all, below which propagation has settled.
TOLERANCE, LOOK = 1e-5, 8
#: Shares of edges that one task of a round hands on.
EDGES = 100_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/"'?#\s>]+)"""


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct(verdict, rule), or null."""
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in reversed(ranked):
        h, slash, p = rule.partition("/")
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(slash + p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(src, dst, weight) of links between hosts and of domain kinship; a public suffix is nobody's parent."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), 1), ascii_lower))).alias("dst"))
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    kin = hosts.select("host", parent.alias("parent")).where((F.col("parent") != "") & ~F.col("parent").isin(*suffixes))
    kin = kin.select(F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("parent").alias("dst")), F.struct(F.col("parent").alias("src"), F.col("host").alias("dst")))).alias("e")).select("e.*")
    return links.unionByName(kin).where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = ROUNDS, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) by personalised PageRank; seeds are (host, n_allow, n_block). Without a number of rounds they go on
    until the ranks settle."""
    both = edges.select(F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("src").alias("u"), F.col("dst").alias("v"), "weight"), F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("u"), F.col("src").alias("v"), "weight"))).alias("e")).select("e.*")
    out = both.groupBy("kind", "u").agg(F.sum("weight").alias("total"))
    flow = written(both.join(out, ["kind", "u"]).select("kind", "u", "v", (F.col("weight") / F.col("total")).alias("share")))
    # cached as dealt out; a lost part is read again from what is written
    flow = flow.repartition(int(flow.sparkSession.conf.get("spark.sql.shuffle.partitions")), "kind", "u").persist()
    # a round writes a file a task: as many tasks as the edges need, not as many as there are partitions
    tasks = 1 + flow.count() // EDGES
    mass = seeds.select("host", F.explode(F.create_map(F.lit("trust"), "n_allow", F.lit("distrust"), "n_block")).alias("kind", "n")).where("n > 0")
    total = mass.groupBy("kind").agg(F.sum("n").alias("total"))
    seed = written(mass.join(F.broadcast(total), "kind").select("kind", F.col("host").alias("u"), (F.col("n") / F.col("total")).alias("rank")).coalesce(tasks))  # two rows
    rank = last = seed
    for k in count() if rounds is None else range(rounds):
        moved = flow.join(rank, ["kind", "u"]).select("kind", F.col("v").alias("u"), (F.col("share") * F.col("rank") * damping).alias("rank"))
        rank = moved.unionByName(seed.select("kind", "u", (F.col("rank") * (1 - damping)).alias("rank"))).coalesce(tasks).groupBy("kind", "u").agg(F.sum("rank").alias("rank"))
        if k % LOOK == LOOK - 1:
            rank = written(rank.coalesce(tasks))
            if rounds is None:
                change = rank.unionByName(last.select("kind", "u", (-F.col("rank")).alias("rank"))).groupBy("kind", "u").agg(F.sum("rank").alias("d")).groupBy("kind").agg(F.sum(F.abs("d")).alias("d"))
                if all(r.d < tolerance for r in change.collect()):  # two rows
                    break
                last = rank
    one = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    ranks = written(rank.groupBy(F.col("u").alias("host")).agg(one("trust"), one("distrust")).coalesce(tasks))
    flow.unpersist()
    return ranks


def judge(pages: DataFrame, rules=RULES, ratio: float = RATIO, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict and the host's trust and distrust."""
    p = with_columns_of(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    p = p.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    n_of = lambda verdict: F.sum((F.coalesce(F.col("fits.verdict"), F.lit("")) == verdict).cast("long"))
    hosts = written(p.groupBy("host").agg(n_of("allow").alias("n_allow"), n_of("block").alias("n_block")))
    ranks = propagate(host_edges(p, hosts), hosts, None)
    return p.drop("html").join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"),
        F.coalesce("fits.verdict", F.when(F.col("distrust") > ratio * F.col("trust"), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def query(pages: DataFrame) -> DataFrame:
    return judge(pages)
