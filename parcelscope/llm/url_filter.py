"""URL filters: rule list, then a path-template tree per host (DataFrame functions only).

1. Rules: a rule ``host/path`` fits its host and all subdomains if the url's path starts
   with the rule's path; the longest fitting rule decides.
2. Template tree, for the rest.  Paths are cut into segments; level by level below each (host,
   template so far), until no node has branches left (a node whose paths all go on alike
   takes the rest of the path as it is):
   * a segment that is not frequent among its siblings is generalised into a wildcard of its shape
     (``{num}``, ``{id}``, ``{slug}``, with the file extension kept) unless its labelled share or its
     next-segment shapes differ significantly from those of the wildcard's pool;
   * sibling branches are merged (``*``) when their next-segment shapes and their labelled share
     of bad pages do not differ significantly from the pool of their siblings.
3. Verdict: a template's bad share, smoothed towards its host's share, which is smoothed
   towards the whole table's; ``block`` from ``PURITY`` on.

Everything after the parse works on counts per (host, path shape), aggregated map-side, so a
hot host costs its number of distinct shapes and not its rows; the rows meet the
verdicts in one join that adaptive execution can split.

A null url or one without ``://`` has an empty host and path.  Labels that are null or
repeated: the worst label of an id counts once.  Repeated rows each give a row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, LOWER, written

# verdict, rule host, rule path: fixed values of the production rule list
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
FREQUENT = 0.05     # a segment with this share of its siblings' pages stays literal
MERGE_Z = 2.58      # merge below this |z| of the labelled share against the siblings' pool
MERGE_TV = 0.25     # and below this total variation of the next segments' shapes
CHANCE = 0.01       # a rare segment's variation may pass MERGE_TV by what chance gives its few pages this often
PRIOR = 5.0         # pseudo-labels of each smoothing level
PURITY = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def shape(seg: Column) -> Column:
    """The wildcard of a segment: kind of its stem, with a short extension kept."""
    ext = F.regexp_extract(seg, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(seg, r"\.[A-Za-z]{1,5}$", "")
    kind = (F.when(seg == "", "").when(seg.rlike(r"^\{"), stem).when(stem.rlike("^[0-9]+$"), "{num}")
            .when(stem.rlike("^[0-9a-fA-F-]{8,}$"), "{id}").when(stem.rlike("[0-9]"), "{mixed}")
            .when(stem.rlike("[-_]"), "{slug}").otherwise("{word}"))
    return F.concat(kind, ext)


def _segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/", ""), "/", -1)


def templates(urls: DataFrame) -> DataFrame:
    """From rows (host, path, n, labelled, bad): (host, key, template, n, labelled, bad) per path key.

    ``key`` is the path with segments that are shapes of their own already folded, by
    which rows find their template.
    """
    t = urls.select("host", folded(F.col("path")).alias("key"), "n", "labelled", "bad")
    t = t.groupBy("host", "key").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    t = t.withColumn("segs", F.split("key", "/", -1)).withColumn("template", F.lit(""))
    done: list[DataFrame] = []
    while True:  # ``segs`` are the segments not yet in the template
        seg, nxt = F.get("segs", F.lit(0)), F.get("segs", F.lit(1))
        t = t.withColumn("seg", seg).withColumn("wild", shape(seg))
        t = t.withColumn("next", F.when(nxt.isNull(), "").otherwise(shape(nxt)))
        node = ["host", "template"]
        # children of every node, with the shapes that follow them
        kids = t.groupBy(*node, "seg", "wild", "next").agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "bad")], F.min("segs").alias("lo"), F.max("segs").alias("hi"))
        kids = written(kids, "kids")  # read many times below: one small plan each
        pool = kids.groupBy(*node, "next").agg(F.sum("n").alias("pn"))
        total = kids.groupBy(*node).agg(*[F.sum(c).alias("t" + c) for c in ("n", "labelled", "bad")],
                                        (F.min("lo") == F.max("hi")).alias("straight"))
        child = kids.groupBy(*node, "seg", "wild").agg(*[F.sum(c).alias("c" + c) for c in ("n", "labelled", "bad")])
        # total variation = sum of the positive parts of (child share - pool share)
        tv = (kids.join(child, [*node, "seg", "wild"]).join(pool, [*node, "next"]).join(total, node)
              .groupBy(*node, "seg").agg(F.sum(F.greatest(F.lit(0.0), F.col("n") / F.col("cn") - F.col("pn") / F.col("tn"))).alias("tv")))
        child = child.join(total, node).join(tv, [*node, "seg"])
        share = (F.col("tbad") + 1) / (F.col("tlabelled") + 2)
        z = F.when(F.col("clabelled") == 0, 0.0).otherwise(
            (F.col("cbad") - F.col("clabelled") * share) / F.sqrt(F.col("clabelled") * share * (1 - share)))
        frequent = F.col("cn") >= FREQUENT * F.col("tn")
        like = (F.abs(z) < MERGE_Z) & (F.col("tv") < MERGE_TV)
        alone = F.col("cn") == F.col("tn")
        child = child.withColumn("part", F.when(F.col("seg") == F.col("wild"), F.col("wild")).when(frequent & like & ~alone, "*")
                                 .when(frequent, F.col("seg")))
        child = written(child, "children")
        apart = _apart(kids.join(child.filter("part is null").select(*node, "seg"), [*node, "seg"]), node)
        child = child.join(apart, [*node, "seg"], "left").withColumn(
            "part", F.coalesce("part", F.when(F.col("apart"), F.col("seg")).otherwise(F.col("wild"))))
        t = t.join(child.select(*node, "seg", "part", "straight"), [*node, "seg"]).select(
            "host", "key", "n", "labelled", "bad",
            F.when(F.col("straight"), F.array().cast("array<string>")).otherwise(F.slice("segs", F.lit(2), F.size("segs"))).alias("segs"),
            F.concat("template", F.lit("/"), F.when(F.col("straight"), F.array_join("segs", "/")).otherwise(F.col("part"))).alias("template"))
        t = written(t, f"templates{len(done)}")
        done.append(t.filter(F.size("segs") == 0).drop("segs"))
        t = t.filter(F.size("segs") > 0)
        if t.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _apart(rare: DataFrame, node: list[str]) -> DataFrame:
    """(node, seg, apart): whether a rare segment differs significantly from the pool of its wildcard.

    The labelled share must differ by the variance of the pool and by that of the segment's own
    (smoothed) share, so that one label alone does not; the total variation must pass ``MERGE_TV`` by more than a
    sample of the segment's size gives by chance.
    """
    sums = ("n", "labelled", "bad")
    total = rare.groupBy(*node, "wild").agg(*[F.sum(c).alias("t" + c) for c in sums], F.countDistinct("next").alias("kinds"))
    pool = rare.groupBy(*node, "wild", "next").agg(F.sum("n").alias("pn"))
    child = rare.groupBy(*node, "seg", "wild").agg(*[F.sum(c).alias("c" + c) for c in sums])
    rows = rare.join(child, [*node, "seg", "wild"]).join(pool, [*node, "wild", "next"]).join(total, [*node, "wild"])
    rows = rows.groupBy(*node, "seg").agg(
        *[F.first(c).alias(c) for c in ("cn", "clabelled", "cbad", "tlabelled", "tbad", "kinds")],
        F.sum(F.greatest(F.lit(0.0), F.col("n") / F.col("cn") - F.col("pn") / F.col("tn"))).alias("tv"))
    share, own = (F.col("tbad") + 1) / (F.col("tlabelled") + 2), (F.col("cbad") + 1) / (F.col("clabelled") + 2)
    z = F.when(F.col("clabelled") == 0, 0.0).otherwise(F.least(
        F.abs(F.col("cbad") - F.col("clabelled") * share) / F.sqrt(F.col("clabelled") * share * (1 - share)),
        F.abs(own - share) / F.sqrt(own * (1 - own) / (F.col("clabelled") + 2))))
    # mean of the variation of cn draws over so many kinds, and the bound on its excess
    noise = 0.5 * F.sqrt((F.col("kinds") - 1) / F.col("cn")) + F.sqrt(-math.log(CHANCE) / (2 * F.col("cn")))
    return rows.select(*node, "seg", ((z >= MERGE_Z) | (F.col("tv") >= MERGE_TV + noise)).alias("apart"))


def folded(path: Column) -> Column:
    """Path with digits-only stems already generalised: few distinct keys per host."""
    return F.array_join(F.transform(_segments(path), lambda s: F.when(
        shape(s).rlike(r"^\{(num|id)\}"), shape(s)).otherwise(s)), "/")


def judged(template_rows: DataFrame) -> DataFrame:
    """(host, key, template, score, verdict) by smoothed labelled purity."""
    total = template_rows.agg(((F.sum("bad") + 1) / (F.sum("labelled") + 2)).alias("prior"))
    prior = total.first()["prior"]  # one number
    prior = float(prior) if prior is not None else 0.5
    host = template_rows.groupBy("host").agg(F.sum("bad").alias("hb"), F.sum("labelled").alias("hl"))
    host = host.select("host", ((F.col("hb") + PRIOR * prior) / (F.col("hl") + PRIOR)).alias("hp"))
    tpl = template_rows.groupBy("host", "template").agg(F.sum("bad").alias("tb"), F.sum("labelled").alias("tl"))
    tpl = tpl.join(host, "host").withColumn("score", (F.col("tb") + PRIOR * F.col("hp")) / (F.col("tl") + PRIOR))
    out = template_rows.select("host", "key", "template").join(tpl.select("host", "template", "score"), ["host", "template"])
    return out.withColumn("method", F.when(F.col("score") >= PURITY, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """Every row of ``pages`` (page_id, url): host, path, rule, verdict, template, score.

    ``labels``: (url_id, bad) where ``url_id`` is the number that ends a url's path and
    ``bad`` 0 or 1.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn(
        "url_id", F.regexp_extract("path", r"([0-9]{1,18})(?:\.[A-Za-z]{1,5}|/)?$", 1).try_cast("long"))
    lab = labels.filter("url_id is not null and bad is not null").groupBy("url_id").agg(F.max("bad").cast("long").alias("bad"))
    seen = rows.groupBy("host", folded(F.col("path")).alias("path"), "url_id").agg(F.count("*").alias("n"))
    seen = seen.join(lab, "url_id", "left").select(
        "host", "path", "n", F.when(F.col("bad").isNull(), 0).otherwise(F.col("n")).cast("long").alias("labelled"),
        (F.coalesce("bad", F.lit(0)) * F.col("n")).cast("long").alias("bad"))
    verdicts = judged(templates(seen.select("host", F.concat(F.lit("/"), "path").alias("path"), "n", "labelled", "bad")))
    out = rows.withColumn("key", folded(F.col("path"))).join(verdicts, ["host", "key"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("by_rule", "method", F.lit("allow")).alias("verdict"), "template", "score")
