"""Operator 2, URL filters: rules, and trust that spreads over links between hosts.

A page that a rule fits is judged by the longest one.  The others are judged by
their host: personalised PageRank runs from the trusted seeds (hosts of pages
that a rule allows) along the links, and from the blocked seeds (hosts of pages
that a rule blocks) against them.  DataFrame functions only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hirelake.llm.common import private, read, written

#: Parts that the pages of one host are dealt into.
SALTS = 32
#: (verdict, host, path): the rules of the query's contract (fixed values).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``, else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.  ``rules`` is a
    configured list; its length is the length of the expression."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): number of links from a page's host to the linked
    host.  A link without a host leads to the page's own host."""
    # an anchor without href is passed over whole, so that the search is linear
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s(?:[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)|[^>]*)"""), F.lit(1))
    rows = pages.where("host != '' and html is not null").select(F.col("host").alias("src"), F.explode(hrefs).alias("href"))
    absolute = F.when(F.startswith("href", F.lit("//")), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    dst = host_of(absolute)
    return (rows.where("href != ''").select("src", F.when(F.instr(absolute, "://") > 0, dst).otherwise(F.col("src")).alias("dst"))
            .where("dst != ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))


def walk(seeds: DataFrame, links: DataFrame, damping: float, steps: int | None = None, tol: float = 1e-6, most: int = 1000) -> DataFrame:
    """(host, mass) of personalised PageRank from ``seeds`` (host, seed; seeds sum to 1).

    ``links`` has (src, dst, share), shares of a source summing to 1.  Mass of
    hosts without links returns to the seeds.  Each step joins the ranks with
    the links on the source and sums by target (pre-aggregated), and is written
    to the shared folder.  It ends when no host's mass changes by more than
    ``tol`` of itself (so every host that is linked at any distance has been
    reached), and raises if that takes over ``most`` steps; ``steps`` takes that
    many instead.
    """
    ranks = seeds.select("host", F.col("seed").alias("mass"))
    for i in range(most if steps is None else steps):
        moved = (ranks.join(links, ranks.host == links.src).select(F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
                 .groupBy("host").agg(F.sum("mass").alias("mass")))
        moved = written(moved, "walk")
        kept = moved.agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]
        back = seeds.select("host", (F.col("seed") * (1.0 - kept)).alias("mass"))
        last, ranks = ranks, moved.unionByName(back).groupBy("host").agg(F.sum("mass").alias("mass"))
        if steps is None:
            both = (ranks.select("host", "mass", F.lit(0.0).alias("last")).unionByName(last.select("host", F.lit(0.0).alias("mass"), F.col("mass").alias("last")))
                    .groupBy("host").agg(F.sum("mass").alias("mass"), F.sum("last").alias("last")))
            if both.where(F.abs(F.col("mass") - F.col("last")) > F.greatest("mass", "last") * tol).isEmpty():
                break
    else:
        if steps is None:
            raise RuntimeError(f"the walk did not settle in {most} steps")
    return written(ranks, "ranks")


def host_scores(pages: DataFrame, damping: float = 0.85, steps: int | None = None) -> DataFrame:
    """(host, trust, distrust) of every host that has a page or is linked.

    ``pages`` has host, html and ``rule_verdict``.
    """
    judged = written(pages.where("host != ''").groupBy("host").agg(
        F.count(F.when(F.col("rule_verdict") == "allow", 1)).cast("double").alias("allowed"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).cast("double").alias("blocked")), "hosts")
    links = written(host_links(pages), "links")
    total = judged.agg(F.sum("allowed"), F.sum("blocked")).first()

    def shares(src: str, dst: str) -> DataFrame:
        out = links.groupBy(F.col(src).alias("src")).agg(F.sum("weight").alias("all"))
        return written(links.select(F.col(src).alias("src"), F.col(dst).alias("dst"), "weight").join(out, "src")
                       .select("src", "dst", (F.col("weight") / F.col("all")).alias("share")), "shares")

    got = judged.select("host").unionByName(links.select(F.explode(F.array("src", "dst")).alias("host"))).distinct()
    for name, col, whole, (src, dst) in (("trust", "allowed", total[0], ("src", "dst")), ("distrust", "blocked", total[1], ("dst", "src"))):
        seeds = judged.where(F.col(col) > 0).select("host", (F.col(col) / (whole or 1.0)).alias("seed"))
        mass = walk(seeds, shares(src, dst), damping, steps if whole else 0)
        got = got.join(mass.select("host", (F.col("mass") * float(whole or 0)).alias(name)), "host", "left")
    return got.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def filter_urls(pages: DataFrame, rules=RULES, damping: float = 0.85, steps: int | None = None, margin: float = 2.0) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``.

    ``trust`` and ``distrust`` are the walks' masses in seed pages.  A page
    without a rule is blocked when its host's distrust is above ``margin``
    times its trust.  Null urls and urls without ``://`` have empty host and
    path, fit no rule and are allowed.  Repeated rows are judged each; null or
    empty html gives no links; input columns with these names are replaced.
    Pages meet their host's scores in ``SALTS`` parts of each host, so that a
    host with a third of all pages is not one task.
    """
    names = ["host", "path", "rule", "verdict", "trust", "distrust"]
    base = pages.drop(*names)
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    own_host, by_rule, salt = (private(pages) + x for x in ("host", "verdict", "salt"))
    parsed = (base.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
              .withColumn("rule", rule).withColumn(by_rule, verdict))
    scores = host_scores(parsed.select("host", "html", F.col(by_rule).alias("rule_verdict")), damping, steps)
    scores = scores.select(F.col("host").alias(own_host), "trust", "distrust", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt + "s"))
    parsed = parsed.withColumn(salt, F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int"))
    judged = parsed.join(scores, (F.col("host") == F.col(own_host)) & (F.col(salt) == F.col(salt + "s")), "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when(distrust > trust * margin, "block").otherwise("allow")
    return judged.select(*base.columns, "host", "path", "rule", F.coalesce(by_rule, own).alias("verdict"),
                         trust.alias("trust"), distrust.alias("distrust"))


def op2_url_graph(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
