"""URL verdicts by rules and, where no rule fits, by a tree of path templates.

A path's segments are generalised: numbers, hex strings and repeated runs become wildcards,
extensions stay. Per host the segments form a tree, built from branching to branching until every
path has ended: of a node with many different children those without labels get one wildcard child,
and labelled children whose shares of blocked URLs do not differ significantly become one branch. A
branch's share is smoothed towards its parent's, the host's towards the share of all; a template
whose smoothed share of blocked URLs is high is rejected. The labels are the verdicts of the rules.

Everything after the first aggregation works on distinct generalised paths, not on pages.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import stored

CHILDREN = 32  # different children of a node beyond which those without labels are one wildcard;
# it changes templates, no verdict: children without labels have their parent's share either way
WEIGHT = 4.0  # labelled URLs that a parent's share counts as
SIMILAR = 1.96  # standard errors within which two shares are taken as equal
REJECT = 0.5

Rules = list[tuple[str, str]]  # (host/path, allow or block)


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(found, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict. A rule fits its host and all subdomains, where
    the path starts with the rule's. The rules are a parameter, so few."""
    found = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def generalised(path: Column) -> Column:
    """The path with variable segments as wildcards: {n} for numbers, {x} for long hex strings, {r}
    for further rounds of one to three segments that follow each other three times or more."""
    numbers = F.regexp_replace(path, r"(?<=/)[0-9]+(?=[./]|$)", "{n}")
    named = F.regexp_replace(numbers, r"(?<=/)[0-9a-fA-F-]{16,}(?=[./]|$)", "{x}")
    return F.regexp_replace(named, r"((?:/[^/]+){1,3}?)\1{2,}(?=/|$)", "$1/{r}")


def _share(blocked: Column, labelled: Column, parent: Column) -> Column:
    return (blocked + WEIGHT * parent) / (labelled + WEIGHT)


def templates(paths: DataFrame) -> DataFrame:
    """host, path, template, share of `paths` (host, path, labelled, blocked), unique in host and
    path.

    A round goes from each node along the segments all of its paths have in common, however
    many, and then to its branches; rows that have come to their end are not written again. So
    there are as many rounds as branchings or ends follow each other on a path.
    """
    total = paths.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    of_all = total.select(
        (F.coalesce("b", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 2)
    ).scalar()
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    of_host = paths.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    of_host = of_host.select("host", _share(F.col("b"), F.col("l"), of_all).alias("share"))
    tree = stored(
        paths.join(of_host, "host").select("*", F.lit("").alias("template"), segments.alias("left"))
    )
    ended = F.size("left") == 0
    rounds = []
    while not (going := tree.where(~ended)).isEmpty():
        # Each step reads the one before several times.
        tree = stored(_along(going))
        rounds.append(tree.where(ended))
        tree = stored(_to_branches(tree.where(~ended)))
        rounds.append(tree.where(ended))
    out = [r.select("host", "path", "template", "share") for r in rounds] or [
        tree.select("host", "path", "template", "share")
    ]
    return reduce(DataFrame.unionByName, out)


NODE = ["host", "template"]


def _along(going: DataFrame) -> DataFrame:
    """Every path moved along the segments it has in common with all paths of its node.

    On them each node has one child with the same labelled URLs, so the share tends to theirs by a
    constant factor a segment. What all paths have in common is what the least and the greatest of
    them have.
    """
    of_node = going.groupBy(*NODE).agg(
        F.sum("labelled").alias("l"),
        F.sum("blocked").alias("b"),
        F.min("left").alias("first"),
        F.max("left").alias("last"),
    )
    differs = F.array_position(
        F.zip_with("first", "last", lambda x, y: x.eqNullSafe(y)), F.lit(False)
    )
    common = F.when(differs > 0, differs - 1).otherwise(F.size("first")).cast("int")
    of_node = of_node.select(*NODE, "l", "b", common.alias("common"))
    l, b, share = F.col("l"), F.col("b"), F.col("share")
    tending = b / l + (share - b / l) * F.pow(WEIGHT / (l + WEIGHT), F.col("common"))
    moved = F.slice("left", F.lit(1), F.col("common"))
    return going.join(of_node, NODE).select(
        "host",
        "path",
        "labelled",
        "blocked",
        F.when((l > 0) & (F.col("common") > 0), tending).otherwise(share).alias("share"),
        F.when(F.col("common") > 0, F.concat("template", F.lit("/"), F.array_join(moved, "/")))
        .otherwise(F.col("template"))
        .alias("template"),
        F.slice("left", F.col("common") + 1, F.size("left")).alias("left"),
    )


def _to_branches(going: DataFrame) -> DataFrame:
    """Every path moved to the branch its next segment belongs to."""
    going = going.withColumn("segment", F.get("left", F.lit(0)))
    return going.join(_branches(going, NODE), [*NODE, "segment"]).select(
        "host",
        "path",
        "labelled",
        "blocked",
        F.col("new_share").alias("share"),
        F.concat("template", F.lit("/"), "branch").alias("template"),
        F.slice("left", 2, F.size("left")).alias("left"),
    )


def _branches(going: DataFrame, node: list[str]) -> DataFrame:
    """branch and its new_share for each child (segment) of a node.

    Labelled children are ordered by their share; one that differs significantly from the one
    before begins a new branch. Children without labels get the parent's share; they stay alone,
    or are one wildcard where the node has many children. Children of one share never differ, so
    only each share's first and last child are compared.
    """
    children = going.groupBy(*node, "segment").agg(
        F.sum("labelled").alias("l"),
        F.sum("blocked").alias("b"),
        F.first("share").alias("parent"),
    )
    children = children.withColumn("rate", F.when(F.col("l") > 0, F.col("b") / F.col("l")))
    of_node = children.groupBy(*node).agg((F.count(F.lit(1)) > CHILDREN).alias("many"))
    child = F.struct("segment", "l", "b")
    rates = (
        children.where("l > 0")
        .groupBy(*node, "rate")
        .agg(
            F.min(child).alias("head"),
            F.max(child).alias("tail"),
            F.sum("l").alias("l"),
            F.sum("b").alias("b"),
            F.first("parent").alias("parent"),
        )
    )
    order = Window.partitionBy(*node).orderBy("rate")
    before = F.lag("tail").over(order)
    l, b, l0, b0 = F.col("head.l"), F.col("head.b"), before["l"], before["b"]
    pooled = (b + b0 + 1) / (l + l0 + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / l + 1 / l0))
    apart = F.coalesce(F.col("rate") - b0 / l0 > SIMILAR * error, F.lit(False)).cast("int")
    number = F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0))
    branch = Window.partitionBy(*node, "number")
    share = _share(F.sum("b").over(branch), F.sum("l").over(branch), F.col("parent"))
    merged = (
        rates.withColumn("apart", apart)
        .withColumn("number", number)
        .select(
            *node, "rate", F.min("head.segment").over(branch).alias("merged"), share.alias("merged_share")
        )
    )
    unlabelled = F.when(F.col("many"), "*").otherwise(F.col("segment"))
    return (
        children.join(of_node, node)
        .join(merged, [*node, "rate"], "left")
        .select(
            *node,
            "segment",
            F.coalesce("merged", unlabelled).alias("branch"),
            F.coalesce("merged_share", "parent").alias("new_share"),
        )
    )


def judge(pages: DataFrame, rules: Rules) -> DataFrame:
    """page_id, host, path, rule, verdict, template, share of `pages` (page_id, url).

    A NULL url, or one without `://`, has an empty host and path; no rule fits it, and the tree
    judges it as a host of its own. Without any labelled URL the share is one half, a reject.
    Repeated rows are judged each. Other columns are ignored.
    """
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, says = longest_rule(rules, F.col("host"), F.col("path"))
    ruled = parsed.select(
        "*", rule.alias("rule"), says.alias("says"), generalised(F.col("path")).alias("general")
    )
    paths = ruled.groupBy("host", F.col("general").alias("path")).agg(
        F.count("says").alias("labelled"), F.count_if(F.col("says") == "block").alias("blocked")
    )
    found = templates(stored(paths)).withColumnRenamed("path", "general")
    by_tree = F.when(F.col("share") >= REJECT, "block").otherwise("allow")
    return ruled.join(found, ["host", "general"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("says", by_tree).alias("verdict"),
        "template",
        "share",
    )
