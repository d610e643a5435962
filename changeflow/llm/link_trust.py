"""URL filter: allow and block rules, and for hosts that no rule knows, trust and distrust along links.

Trust starts at hosts that rules allow and follows links; distrust starts at hosts that rules block and follows links
backwards, since who links to a bad host is suspect while who is linked from one is not. Both are personalised PageRanks
over the graph of hosts. Distrust is divided among all hosts that link to a bad one, so how much of it is enough to matter
is asked of a host's exposure instead: the share of its own links that leads to blocked hosts, by any number of steps,
which does not depend on how many others link there. A host with more distrust than trust and enough exposure is blocked.
All of it is DataFrame functions: links are summed to host edges before anything is joined, and a round is one join and one sum.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 1000
DAMPING = 0.85
#: Rounds between two looks at how far the ranks moved, and how many such looks there may be. What moves shrinks by the damping
#: each round, so that hundreds of rounds are only reached with a damping close to one.
BLOCK_OF_ROUNDS = 8
MOST_BLOCKS = 500
TOLERANCE = 1e-6
#: A host is a seed if rules judge at least this share of its pages that way.
SEED_SHARE = 0.5
#: Least exposure that blocks, where a blocked seed alone has 0.15 (what does not come by links).
LEAST_DISTRUST = 0.01
TRUST, DISTRUST, EXPOSURE = 0, 1, 2


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule(ALLOW, "com"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return lower_ascii(F.coalesce(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits; NULL if none does. The rules are part of the plan."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are compiled into a plan")
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    chain = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return none if chain is None else chain.otherwise(none)


def linked_hosts(html: Column) -> Column:
    """Distinct hosts that a page's ``href`` attributes name; relative links name none."""
    found = F.regexp_extract_all(html, F.lit("(?i)\\bhref\\s*=\\s*[\"']?\\s*(?:https?:)?//([^/?#\"'\\s>]+)"), 1)
    return F.array_distinct(F.transform(found, lower_ascii))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, pages``: how many pages of host ``src`` link to host ``dst``; links within a host are left out."""
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(linked_hosts(F.col(html))).alias("dst"))
    return links.filter("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("pages"))


def _steps(edges: DataFrame) -> DataFrame:
    """``kind, node, to, p``: a step of trust goes along a link, one of distrust against it, in proportion to pages.

    Exposure goes against a link too, but in proportion to the pages of the host that links, not of all that link there.
    """
    out = edges.groupBy(F.col("src").alias("node")).agg(F.sum("pages").alias("whole"))
    back = edges.groupBy(F.col("dst").alias("node")).agg(F.sum("pages").alias("whole"))
    step = lambda kind, node, to: F.struct(F.lit(kind).alias("kind"), F.col(node).alias("node"), F.col(to).alias("to"))
    p = (F.col("pages") / F.col("whole")).alias("p")
    own = edges.withColumn("node", F.col("src")).join(out, "node").select(
        F.explode(F.array(step(TRUST, "src", "dst"), step(EXPOSURE, "dst", "src"))).alias("step"), p
    )
    against = edges.withColumn("node", F.col("dst")).join(back, "node").select(step(DISTRUST, "dst", "src").alias("step"), p)
    return own.unionByName(against).select("step.*", "p")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """``kind, node, rank`` from ``seeds`` (``kind, node``), each starting with one.

    What reaches a node without a further step is lost rather than dealt anew, so ranks of nodes far from any seed
    are small but never negative. Ranks are written every few rounds, which cuts the lineage, and the rounds end when
    no rank has moved by more than the tolerance, whatever their number.
    """
    steps = stored(_steps(edges), "steps")
    start = seeds.select("kind", "node", F.lit(1 - damping).alias("x"))
    ranks = start.withColumnRenamed("x", "rank")
    for _ in range(MOST_BLOCKS):
        before = ranks
        for _ in range(BLOCK_OF_ROUNDS):
            moved = steps.join(ranks, ["kind", "node"]).select("kind", F.col("to").alias("node"), (F.col("p") * F.col("rank") * damping).alias("x"))
            ranks = moved.unionByName(start).groupBy("kind", "node").agg(F.sum("x").alias("rank"))
        ranks = stored(ranks, "ranks")
        old = before.withColumnRenamed("rank", "old")
        change = ranks.join(old, ["kind", "node"], "left").agg(F.max(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0)))))
        if (change.first()[0] or 0.0) <= TOLERANCE:
            return ranks
    raise ArithmeticError(f"ranks still move after {MOST_BLOCKS * BLOCK_OF_ROUNDS} rounds")


def host_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """``host, trust, distrust, host_verdict`` for every host that trust or distrust reaches."""
    edges = stored(host_edges(pages, url, html), "edges")
    host, path = F.col("host"), F.col("path")
    judged = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).filter("host <> ''")
    # a host known from links alone counts as one page at its root
    named = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct().withColumn("path", F.lit("/")).withColumn("n", F.lit(0))
    own = judged.withColumn("n", F.lit(1)).unionByName(named)
    seen = own.withColumn("verdict", matching_rule(host, path, rules)["verdict"])
    shares = seen.groupBy("host").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in (ALLOW, BLOCK)],
        *[F.max(F.when((F.col("n") == 0) & (F.col("verdict") == v), 1).otherwise(0)).alias(f"root_{v}") for v in (ALLOW, BLOCK)],
    )
    share = lambda v: F.when(F.col("n") > 0, F.col(v) >= SEED_SHARE * F.col("n")).otherwise(F.col(f"root_{v}") == 1)
    # half allowed and half blocked is blocked
    kind = F.when(share(BLOCK), DISTRUST).when(share(ALLOW), TRUST)
    judged_so = shares.select(kind.alias("by"), F.col("host").alias("node")).filter("by is not null")
    kinds = F.when(F.col("by") == DISTRUST, F.array(F.lit(DISTRUST), F.lit(EXPOSURE))).otherwise(F.array("by"))
    seeds = stored(judged_so.select(F.explode(kinds).alias("kind"), "node"), "seeds")
    ranks = propagate(edges, seeds)
    side = lambda k: F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0))
    scores = ranks.groupBy(F.col("node").alias("host")).agg(
        side(TRUST).alias("trust"), side(DISTRUST).alias("distrust"), side(EXPOSURE).alias("exposure")
    )
    bad = (F.col("distrust") > F.col("trust")) & (F.col("exposure") >= LEAST_DISTRUST)
    return scores.select("host", "trust", "distrust", F.when(bad, BLOCK).otherwise(ALLOW).alias("host_verdict"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row per row of ``pages``: id, ``host, path, rule, verdict``, and the host's ``trust`` and ``distrust``.

    The longest fitting rule decides, else the host's verdict; a host that neither reaches is allowed, as is a URL
    without a host. NULL html has no links.
    """
    verdicts = host_verdicts(pages, rules, url, html)
    own = pages.select(F.col(id_column).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = own.withColumn("by", matching_rule(F.col("host"), F.col("path"), rules))
    return ruled.join(verdicts, "host", "left").select(
        F.col("page").alias(id_column),
        "host",
        "path",
        F.col("by.rule").alias("rule"),
        F.coalesce("by.verdict", "host_verdict", F.lit(ALLOW)).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
