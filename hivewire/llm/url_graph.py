"""URL filter by link-graph propagation (operator 8).

Rules judge a url by host suffix and path prefix.  Hosts with allowed pages
only are trusted seeds, hosts with blocked pages only are blocked seeds.  Trust
is a personalised PageRank from the trusted seeds along host links; distrust is
one from the blocked seeds against them (whoever links to a blocked host is
suspect).  A host is blocked when its distrust passes a threshold and its
share in trust plus distrust passes another; pages without a rule get their
host's verdict.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, join_unique, prepare, written

DAMPING = 0.85
DISTRUST = 1e-3        # least distrust, relative to one blocked seed's own
SHARE = 0.5            # least share of distrust in distrust plus trust
LEFT = 1e-3            # mass still to be spread when propagation ends, relative to the least distrust
FOLD = 16              # rounds after which what came in is added up


@dataclass(frozen=True)
class Rule:
    """``action`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (name, action); ties: blocking first."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.name), r.action == "block", r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, dst, n``: links between different hosts in the pages' ``href``
    attributes (relative links stay on their host)."""
    links = pages.select(host_of(F.col(url_col)).alias("src"),
                         F.explode(F.regexp_extract_all(F.col(html_col), F.lit(r"""(?i)href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""))).alias("to"))
    dst = host_of(F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), "to")).otherwise(F.col("to")))
    return (links.select("src", dst.alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def personalised_rank(edges: DataFrame, seeds: DataFrame, left: float, damping: float = DAMPING) -> DataFrame:
    """``host, score``: random walk along ``edges(src, dst, n)`` (chosen in proportion
    to ``n``) that restarts at the ``seeds`` with probability 1 - ``damping``;
    walks that end at a host without links are not continued.

    A round spreads what the last one brought in: one join and one grouped sum,
    written to the shared folder.  All later rounds together bring in at most
    ``damping / (1 - damping)`` of a round's mass, and rounds end when that is no
    more than ``left``: no score is short by more, however far the walk goes.
    The mass falls by ``damping`` a round at least, so that point comes."""
    count = seeds.count()
    start = seeds.select("host", F.lit((1 - damping) / max(1, count)).alias("score"))
    if not count or edges.isEmpty():
        return start
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    weight = written(join_unique(edges, out, "src", fixed=False).select("src", "dst", (F.col("n") / F.col("out")).alias("w")), "weights")
    summed = lambda parts: reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("score").alias("score"))
    parts = [written(start, "seeds")]
    while True:
        new = written(join_unique(weight, parts[-1].select(F.col("host").alias("src"), "score"), "src", "inner", fixed=False).select(
            F.col("dst").alias("host"), (F.col("score") * F.col("w") * damping).alias("score"))
            .groupBy("host").agg(F.sum("score").alias("score")), "spread")
        mass = new.agg(F.sum("score").alias("s")).first()["s"] or 0.0
        if mass * damping / (1 - damping) <= left:
            return summed([*parts, new])
        if len(parts) >= FOLD:
            whole = written(summed(parts), "ranks")
            discard(*parts)
            parts = [whole]
        parts.append(new)


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per page.

    Null urls and urls without ``://`` have an empty host and path, fit no rule
    and are allowed, as are hosts that neither seed reaches; a null page has no
    links; null and repeated ids keep one row per page.  An empty table gives no
    rows; other columns are ignored."""
    prepare(pages.sparkSession)
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))
    table = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    table = written(table.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("r.name").alias("rule"), F.col("r.action").alias("action")), "pages")
    edges = written(host_links(p), "host-links")
    hosts = written(table.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("action") == "allow").alias("ok"), F.count_if(F.col("action") == "block").alias("bad")), "hosts")
    blocked = hosts.where("bad > 0 AND ok = 0").select("host")
    floor = DISTRUST * (1 - DAMPING) / max(1, blocked.count())
    trust = personalised_rank(edges, hosts.where("ok > 0 AND bad = 0").select("host"), LEFT * floor)
    distrust = personalised_rank(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"), blocked, LEFT * floor)
    scores = written(hosts.select("host").join(trust.select("host", F.col("score").alias("trust")), "host", "left")
                     .join(distrust.select("host", F.col("score").alias("distrust")), "host", "left")
                     .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "scores")
    bad = (F.col("distrust") >= floor) & (F.col("distrust") >= SHARE * (F.col("trust") + F.col("distrust")))
    got = join_unique(table, scores, "host", fixed=False)
    verdict = F.coalesce("action", F.when(bad, "block").otherwise("allow"))
    return got.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"),
                      F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
