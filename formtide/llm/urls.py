"""URL filters by a tree of path templates.

Pages collapse to (host, path pattern) with counts first, so the tree is built from patterns, not pages. Node by node,
a host's variable segments become wildcards, branches whose labelled rate does not differ from their node's are merged, and
templates are rejected by their labelled purity. Purities are smoothed: a template's towards that of the node it branched
off, that towards the node above, a host's towards the overall rate. A template with too few labels of its own is no evidence
against its pages, whatever its neighbours are, and is allowed. Labels come from the rules: what they allow is good, what they
block is bad. Built-in column functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.operators.sizing import broadcast_if_small
from formtide.session import materialize

#: A node with more branches than this is variable, and its branches below an even share become "*".
BRANCHES = 20
#: Labels that a branch needs to be compared with its node and a template to be rejected, and the squared z score up to which
#: a branch is similar to its node.
MIN_LABELS = 5
SIMILAR = 3.84
#: Labels that the purity above counts as, and the purity below which a template is rejected.
SMOOTHING = 5.0
PURITY = 0.5


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains and paths that begin as the rule's."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, parts, 1), upper, upper.lower()), F.regexp_extract(url, parts, 2)


def matching_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls; of equally long ones, block goes first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def pattern(path: Column) -> Column:
    """All segments with digits generalised."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/"), lambda s: s != "")


def _purity(good: Column, labels: Column, above: Column) -> Column:
    return (good + SMOOTHING * above) / (labels + SMOOTHING)


def templates(patterns: DataFrame, overall: float = 1.0) -> DataFrame:
    """``patterns`` with their template and ``above``, the purity it is smoothed towards, from rows (host, segments, pages,
    good, bad), one per host and pattern.

    A round takes every node to the first segment in which its patterns differ, however deep that is, so rounds follow the
    branching and not the length of paths. Patterns that end before have no other branch to be compared with and leave as
    they are; the others choose between their segment and "*".
    """
    start = {"template": F.lit(""), "level": F.lit(0), "above": F.lit(overall).cast("double")}
    rows = materialize(patterns.withColumns(start), "templates")
    ended, node = [], ["host", "template"]
    sums = [F.sum(c).alias(c) for c in ("pages", "good", "bad")]
    join = lambda first, last: F.when(
        F.lit(last) > F.lit(first), F.concat(F.lit("/"), F.array_join(F.slice("segments", first + 1, last - first), "/"))
    ).otherwise(F.lit(""))
    while not rows.isEmpty():
        longest = rows.groupBy(*node).agg(F.max_by("segments", F.size("segments")).alias("longest"))
        # Above their level the patterns of a node may differ where a "*" stands.
        rest = lambda c: F.slice(c, F.col("level") + 1, F.size("segments") - F.col("level"))
        same = F.zip_with(rest("segments"), rest("longest"), lambda x, y: x == y)
        differs = F.nullif(F.array_position(same, F.lit(False)), F.lit(0).cast("long")) - 1 + F.col("level")
        rows = materialize(rows.join(longest, node).withColumn("differs", differs).drop("longest"), "templates")
        split = rows.groupBy(*node).agg(F.min("differs").cast("int").alias("split"))
        rows = rows.drop("differs").join(split, node)
        goes_on = F.coalesce(F.size("segments") > F.col("split"), F.lit(False))
        left = rows.filter(~goes_on)
        ended.append(left.withColumn("template", F.concat("template", join(F.col("level"), F.size("segments")))).drop("split", "level"))
        live = rows.filter(goes_on).withColumns(
            {"template": F.concat("template", join(F.col("level"), F.col("split"))), "segment": F.get("segments", F.col("split"))}
        )
        branches = live.groupBy(*node, "segment").agg(*sums)
        nodes = branches.groupBy(*node).agg(
            F.count("*").alias("n"), F.sum("pages").alias("all"), F.sum("good").alias("g"), F.sum(F.col("good") + F.col("bad")).alias("known")
        )
        labels, known = F.col("good") + F.col("bad"), F.col("known")
        rate, mean = (F.col("good") + 0.5) / (labels + 1), (F.col("g") + 0.5) / (known + 1)
        variable = (F.col("n") > BRANCHES) & (F.col("pages") * BRANCHES < F.col("all"))
        similar = (F.col("n") > 1) & (labels >= MIN_LABELS) & ((rate - mean) * (rate - mean) * labels <= SIMILAR * mean * (1 - mean))
        chosen = F.when(variable | similar, F.lit("*")).otherwise(F.col("segment"))
        steps = branches.join(nodes, node).select(*node, "segment", chosen.alias("step"), "g", "known")
        rows = live.join(steps, [*node, "segment"]).withColumns(
            {
                "template": F.concat("template", F.lit("/"), F.col("step")),
                "level": F.col("split") + 1,
                "above": _purity(F.col("g"), known, F.col("above")),
            }
        )
        rows = materialize(rows.select(*patterns.columns, *start), "templates")
    return reduce(DataFrame.unionByName, ended) if ended else rows.drop("level")


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, template, n_labels and purity of the template.

    Null urls and urls without "://" have an empty host and path, which form a template like others. Without any label at all
    the overall rate is 1. Repeated rows stay.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    rows = rows.select("*", rule.alias("rule"), verdict.alias("given"), pattern(F.col("path")).alias("segments"))
    patterns = rows.groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count_if(F.col("given") == "allow").alias("good"), F.count_if(F.col("given") == "block").alias("bad")
    )
    patterns = materialize(patterns, "patterns")
    good, labels = patterns.agg(F.sum("good"), F.sum(F.col("good") + F.col("bad"))).first()
    known = materialize(templates(patterns, good / labels if labels else 1.0), "templates")
    counts = known.groupBy("host", "template").agg(
        F.sum("good").alias("g"), F.sum(F.col("good") + F.col("bad")).alias("n_labels"), F.min("above").alias("above")
    )
    judged = counts.select("host", "template", "n_labels", _purity(F.col("g"), F.col("n_labels"), F.col("above")).alias("purity"))
    judged = known.select("host", "segments", "template").join(judged, ["host", "template"])
    judged = broadcast_if_small(materialize(judged, "templates"))
    out = rows.join(judged, ["host", "segments"])
    own = F.when((F.col("n_labels") >= MIN_LABELS) & (F.col("purity") < PURITY), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "template", "n_labels", "purity")
