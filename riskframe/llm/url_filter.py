"""URL filters: explicit host/path rules, and a path-template tree judged by smoothed labelled purity.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import cut

# The rules of the contract, (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A parent generalises children with less than RARE of its pages if the entropy of its children is more
#: than VARIED of the largest that so many pages can have.
VARIED = 0.5
RARE = 0.05
#: Siblings are merged if their next level differs by at most so much (total variation) from the
#: pooled siblings, and their smoothed block rate from the pooled one by at most RATE_GAP.
SHAPE_GAP = 0.3
RATE_GAP = 0.25
#: Smoothing: a template counts as PRIOR_N more labelled pages, with the block rate of its shapes in the parent
#: domain, that one again with the rate of its parent, and a top-level domain with PRIOR.
PRIOR, PRIOR_N = 0.1, 4.0
#: Parts of each domain's rates in the join with its hosts, so that no domain is one task.
SALTS = 8
#: A host of more labels is no domain name and has no parents.
MAX_LABELS = 127
#: Hidden third of the ruled pages in ``holdout``.
HIDDEN = 3
#: A template is rejected from this smoothed block rate on.
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: then up to ``? #``."""
    tail = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(tail, r"^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def apply_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def rate(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + prior * PRIOR_N) / (labelled + PRIOR_N)


def parent_rates(shapes: DataFrame) -> DataFrame:
    """``shapes`` with ``prior``: the smoothed block rate of the same shape in the host's parent domain.

    The parent of a.b.c is b.c, its parent c; every one is smoothed by the next, the last by PRIOR.  A domain's
    rate is over its labelled hosts, whatever their size, so no single host speaks for a domain.  Domains
    without labelled pages of the shape change nothing, so only labelled ones meet.
    """
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 10**6), "."))
    ancestors = F.when(F.size(labels).between(2, MAX_LABELS), above).otherwise(F.array().cast("array<string>"))
    salt = F.pmod(F.xxhash64("host"), F.lit(SALTS)).cast("int")
    known = (shapes.where("labelled > 0").select(F.explode(ancestors).alias("domain"), "shape", (F.col("blocked") / F.col("labelled")).alias("share"))
             .groupBy("domain", "shape").agg(F.count(F.lit(1)).alias("l"), F.sum("share").alias("b"))
             .withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS))))))
    rates = (shapes.select("host", "shape", salt.alias("salt"), F.explode(ancestors).alias("domain"))
             .join(known, ["domain", "shape", "salt"])
             .groupBy("host", "shape")
             .agg(F.array_sort(F.collect_list(F.struct(F.length("domain").alias("size"), "l", "b"))).alias("up")))
    prior = F.aggregate("up", F.lit(PRIOR), lambda r, x: rate(x["b"], x["l"], r))
    return (shapes.join(rates.select("host", "shape", prior.alias("prior")), ["host", "shape"], "left")
            .withColumn("prior", F.coalesce("prior", F.lit(PRIOR))))


def rejected(blocked: str, labelled: str, prior: Column) -> Column:
    return (F.col(blocked) > F.col(labelled) * REJECT) | (rate(F.col(blocked), F.col(labelled), prior) >= REJECT)


def templates(shapes: DataFrame) -> DataFrame:
    """host, shape, template, n, labelled, blocked, prior of each distinct (host, shape), level by level.

    Generalised siblings share the segment ``*``.  Those that are rejected by themselves never
    share it with others: they keep their names, or share ``*!``.  So pooling alone never brings ``*`` to REJECT.
    ``shapes`` has host, shape, segs (array of segments), n, labelled, blocked, prior: one row per distinct
    shape, so the loop never touches single pages again.  A shape that is alone at its node keeps its further
    segments: the loop ends as soon as no two shapes share a node, however long paths are.
    """
    names = ["host", "shape", "parent", "n", "labelled", "blocked", "prior"]
    tree, done, level = cut(shapes.withColumn("parent", F.lit(""))), [], 0
    while True:
        nodes = tree.groupBy("host", "parent").agg((F.count(F.lit(1)) > 1).alias("shared"))
        tree = tree.join(nodes, ["host", "parent"])
        rest = F.array_join(F.slice("segs", level + 1, 10**9), "/")
        alone = tree.where(~F.col("shared"))
        done.append(alone.withColumn("parent", F.when(F.size("segs") > level, F.concat("parent", F.lit("/"), rest))
                                     .otherwise(F.col("parent"))).select(names))
        tree = cut(_level(tree.where("shared").drop("shared"), level))
        done.append(tree.where(F.size("segs") <= level).select(names))
        tree, level = tree.where(F.size("segs") > level), level + 1
        if tree.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return cut(out.withColumnRenamed("parent", "template"))


def _level(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` with the generalised segment of this level appended to ``parent``."""
    tree = tree.withColumn("seg", F.get("segs", F.lit(level))).withColumn(
        "next", F.coalesce(F.get("segs", F.lit(level + 1)), F.lit("")))
    weighted = (F.sum(F.col("n") * F.col("prior")) / F.sum("n")).alias("prior")
    # 1. variable segments: rare children of a parent with many children
    child = (tree.groupBy("host", "parent", "seg")
             .agg(F.sum("n").alias("cn"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l"), weighted)
             .withColumn("lean", rejected("b", "l", F.col("prior"))))
    named = F.when(F.col("seg").isNotNull(), F.col("cn"))
    parent = child.groupBy("host", "parent").agg(
        F.sum("cn").alias("pn"), F.sum(named).alias("sn"), F.sum(named * F.log(named)).alias("nlogn"))
    most = F.log("sn")
    varied = most - F.col("nlogn") / F.col("sn") > most * VARIED + 1e-9
    wide = (child.join(parent, ["host", "parent"])
            .where(varied & (F.col("cn") < F.col("pn") * RARE) & F.col("seg").isNotNull() & ~F.col("lean"))
            .select("host", "parent", "seg", F.lit(True).alias("rare")))
    tree = tree.join(wide, ["host", "parent", "seg"], "left")
    tree = tree.withColumn("seg", F.when(F.col("rare"), F.lit("*")).otherwise(F.col("seg"))).drop("rare")
    # 2. similar siblings: next-level distribution and smoothed block rate against the pooled siblings
    cell = (tree.where(F.col("seg").isNotNull()).groupBy("host", "parent", "seg", "next")
            .agg(weighted, F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    pool = cell.groupBy("host", "parent", "next").agg(
        F.sum("n").alias("pool_n"), F.sum("labelled").alias("pool_l"), F.sum("blocked").alias("pool_b"))
    whole = pool.groupBy("host", "parent").agg(
        F.sum("pool_n").alias("all_n"), F.sum("pool_l").alias("all_l"), F.sum("pool_b").alias("all_b"))
    own = cell.groupBy("host", "parent", "seg").agg(
        weighted, F.sum("n").alias("own_n"), F.sum("labelled").alias("own_l"), F.sum("blocked").alias("own_b"))
    # total variation = 1 - sum of the smaller shares, which only cells that exist add to
    near = (cell.drop("prior").join(pool, ["host", "parent", "next"]).join(whole, ["host", "parent"])
            .join(own, ["host", "parent", "seg"])
            .groupBy("host", "parent", "seg")
            .agg(F.sum(F.least(F.col("n") / F.col("own_n"), F.col("pool_n") / F.col("all_n"))).alias("shared"),
                 *(F.first(c).alias(c) for c in ("own_b", "own_l", "all_b", "all_l", "prior"))))
    pooled = F.when(F.col("all_l") > 0, F.col("all_b") / F.col("all_l")).otherwise(PRIOR)
    alike = near.where(
        (F.col("shared") >= 1 - SHAPE_GAP - 1e-9)
        & (F.abs(rate(F.col("own_b"), F.col("own_l"), F.col("prior")) - pooled) <= RATE_GAP + 1e-9)
    ).select("host", "parent", "seg", F.when(rejected("own_b", "own_l", F.col("prior")), "*!").otherwise("*").alias("alike"))
    several = alike.groupBy("host", "parent", "alike").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    alike = alike.join(several, ["host", "parent", "alike"], "left_semi")
    tree = tree.join(alike, ["host", "parent", "seg"], "left")
    seg = F.coalesce("alike", "seg")
    return tree.withColumn("parent", F.when(F.col("seg").isNull(), F.col("parent"))
                           .otherwise(F.concat("parent", F.lit("/"), seg))).drop("alike", "next", "seg")


def shape_of(path: Column) -> Column:
    """Lower case, digits as ``#``, and a segment that repeats in succession once, as ``name+``."""
    lower = F.regexp_replace(F.regexp_replace(F.lower(path), r"[0-9]+", "#"), "/+", "/")
    trimmed = F.regexp_replace(lower, r"^/|/$", "")
    return F.regexp_replace(trimmed, r"(?<![^/])([^/]+)(?:/\1(?![^/]))++", "$1+")


def judge(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (host, path and a column ``label`` of allow, block or null) with template, block_rate and
    ``method``, the verdict of the template."""
    rows = rows.withColumn("shape", shape_of(F.col("path")))
    shapes = rows.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count(label).alias("labelled"),
        F.coalesce(F.sum((F.col(label) == "block").cast("bigint")), F.lit(0)).alias("blocked"))
    segs = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split("shape", "/"))
    tree = templates(parent_rates(cut(shapes.withColumn("segs", segs))))
    judged = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), (F.sum(F.col("n") * F.col("prior")) / F.sum("n")).alias("p"))
    named = (tree.select("host", "shape", "template").join(judged, ["host", "template"])
             .select("host", "shape", "template", rate(F.col("b"), F.col("l"), F.col("p")).alias("block_rate")))
    method = F.when(F.col("block_rate") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(named, ["host", "shape"], "left").withColumn("method", method)


def ruled_pages(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("ruled"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, block_rate.

    A page that a rule fits has the rule's verdict and is a labelled example of its template.  Other
    pages have the method's: ``block`` if their template's smoothed block rate is REJECT or more.
    Templates live within a host; a host with few labelled pages leans on the same shapes of its parent
    domains.  Digits of a segment are generalised to ``#``; an empty or missing
    path has the template ''.  A null url, or one without ``://``, has empty host and path and no
    rule; repeated rows count as often as they stand; further columns of any name are not read.  Siblings without
    labelled pages differ from rejected ones by their block rate, so a rejected branch does not take them along.
    """
    return (judge(ruled_pages(pages, rules), "ruled")
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", "method").alias("verdict"), "template", "block_rate"))


def holdout(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, by: str = "path") -> DataFrame:
    """page_id, host, ruled, method of the ruled pages whose rule the tree did not see: those where a hash of
    ``by`` (path or host) is divisible by HIDDEN.  How well templates foretell rules: by path within known hosts, by
    host for hosts without any label."""
    hidden = F.pmod(F.xxhash64(by), F.lit(HIDDEN)) == 0
    rows = ruled_pages(pages, rules).withColumn("seen", F.when(~hidden, F.col("ruled")))
    return (judge(rows, "seen").where(F.col("ruled").isNotNull() & hidden)
            .select("page_id", "host", "ruled", "method"))


def op3(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages)
