"""URL filters: host rules, and a path-template tree learnt per host.

Variable path segments become wildcards by their form; sibling branches whose
labelled shares don't differ statistically are merged; a template is rejected
where the smoothed purity of its branch is clearly below that of all labels.
Branches are grouped by one half of the labels and judged by the other, as the
worst of many siblings would be bad by their choice alone.  Everything is
DataFrame expressions over counts per distinct template, so a host with a third
of all pages is a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize


@dataclass(frozen=True)
class TreeParams:
    """bins: siblings are sorted by smoothed bad share in so many steps, whatever their number, so what is folded of a node is bounded.
    depth: deeper segments are one wildcard; there are no more levels than the longest path has.

    merge_z: a sibling whose bad share differs by less from that of the group
    before it joins the group.  prior_weight labels of the overall share are
    added to each branch; one with at least min_labels in the judging half is
    rejected where it is certain, by reject_z standard deviations of its
    posterior, that its odds of bad pages are over max_odds times the overall ones.
    """

    bins: int = 64
    depth: int = 16
    merge_z: float = 1.96
    prior_weight: float = 10.0
    min_labels: int = 10
    reject_z: float = 3.0
    max_odds: float = 2.0


@dataclass(frozen=True)
class Rule:
    """A short policy list of these is given as a parameter: host (with subdomains), path start, verdict."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise(F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column, depth: int) -> Column:
    """Path segments with variable forms generalised; what is deeper than depth becomes one wildcard."""
    seg = F.filter(F.split(path, "/"), lambda s: s != "")
    form = lambda s: F.when(s.rlike(r"^[0-9]+$"), "{n}").when(s.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.concat(F.lit("{n}"), F.regexp_extract(s, r"\.[A-Za-z]+$", 0))).when(s.rlike(r"^[0-9a-fA-F-]{8,}$") | (F.length(s) > 40), "{id}").when(s.rlike(r"[0-9]{3,}"), "{mixed}").otherwise(s)
    out = F.transform(seg, form)
    return F.when(F.size(out) > depth, F.concat(F.slice(out, 1, depth), F.array(F.lit("**")))).otherwise(out)


#: Labels and bad ones of the last group, its number, and the bins so far with their groups, first and last names.
_GROUPS = "struct<n:long,b:long,k:int,out:array<struct<_bin:int,_group:int,lo:string,hi:string>>>"


def _grouped(a: Column, x: Column, p: TreeParams) -> Column:
    """a after the siblings of bin x: in the last group, or in a new one.  Without labels they stay with their neighbours, and aren't evidence."""
    n, b, k = F.coalesce(a["n"], F.lit(0)), F.coalesce(a["b"], F.lit(0)), F.coalesce(a["k"], F.lit(0))
    pooled = (b + x["b"] + 1) / (n + x["n"] + 2)
    at_least = lambda c: F.greatest(c, F.lit(1))
    z = (x["b"] / at_least(x["n"]) - b / at_least(n)) / F.sqrt(pooled * (1 - pooled) * (1 / at_least(x["n"]) + 1 / at_least(n)))
    new = F.coalesce((n > 0) & (x["n"] > 0) & (z > p.merge_z), F.lit(False))
    k = k + new.cast("int")
    one = F.array(F.struct(x["_bin"].alias("_bin"), k.alias("_group"), x["lo"].alias("lo"), x["hi"].alias("hi")))
    return F.struct(
        (F.when(new, 0).otherwise(n) + x["n"]).cast("long").alias("n"), (F.when(new, 0).otherwise(b) + x["b"]).cast("long").alias("b"), k.alias("k"),
        F.when(a.isNull(), one).otherwise(F.concat(a["out"], one)).alias("out"),
    ).cast(_GROUPS)


def _branch(bins: Column, x: Column) -> Column:
    """The name of x's group: its only segment, or the first and last one; bins are few."""
    mine = F.filter(bins, lambda y: y["_group"] == x["_group"])
    lo, hi = F.array_min(F.transform(mine, lambda y: y["lo"])), F.array_max(F.transform(mine, lambda y: y["hi"]))
    return F.when(lo == hi, lo).otherwise(F.concat(F.lit("("), lo, F.lit("|..|"), hi, F.lit(")")))


def build_tree(pages: DataFrame, p: TreeParams) -> DataFrame:
    """pages: _host, _shape, _bad (0, 1 or null), _side (1: the label judges, 0: it groups).

    Returns (_host, _shape, template, n_labels, bad_share, rejected), labels and share of the judging half.
    """
    n = lambda side: F.count(F.when(F.col("_side") == side, F.col("_bad")))
    b = lambda side: F.coalesce(F.sum(F.when(F.col("_side") == side, F.col("_bad"))), F.lit(0))
    leaves = pages.groupBy("_host", "_shape").agg(n(0).alias("n0"), b(0).alias("b0"), n(1).alias("n1"), b(1).alias("b1"))
    tree = materialize(leaves.withColumn("_node", F.lit("")), "url-shapes")
    total = tree.agg(F.sum(F.col("n0") + F.col("n1")).alias("n"), F.sum(F.col("b0") + F.col("b1")).alias("b"), F.max(F.size("_shape")).alias("levels")).first()
    prior = ((total["b"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)
    for level in range(total["levels"] or 0):
        tree = tree.withColumn("_seg", F.when(F.size("_shape") > level, F.get("_shape", F.lit(level))))
        # Children of each node with what is below them, and then bins of children, are counted before they meet, so a wide node is a few partial sums.
        kids = tree.where(F.col("_seg").isNotNull()).groupBy("_host", "_node", "_seg").agg(F.sum("n0").alias("n"), F.sum("b0").alias("b"))
        share = (F.col("b") + prior * p.prior_weight) / (F.col("n") + p.prior_weight)
        kids = kids.withColumn("_bin", F.least(F.floor(share * p.bins), F.lit(p.bins - 1)).cast("int"))
        bins = kids.groupBy("_host", "_node", "_bin").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("_seg").alias("lo"), F.max("_seg").alias("hi"))
        nodes = bins.groupBy("_host", "_node").agg(F.sort_array(F.collect_list(F.struct("_bin", "n", "b", "lo", "hi"))).alias("_bins"))  # p.bins at most
        # By bad share; a new group starts where a bin differs clearly from the whole group before it.
        nodes = nodes.select("_host", "_node", F.aggregate("_bins", F.lit(None).cast(_GROUPS), lambda a, x: _grouped(a, x, p)).getField("out").alias("_bins"))
        nodes = nodes.select("_host", "_node", F.inline(F.transform("_bins", lambda x: F.struct(x["_bin"].alias("_bin"), _branch(F.col("_bins"), x).alias("_branch")))))
        named = kids.join(nodes, ["_host", "_node", "_bin"]).select("_host", "_node", "_seg", "_branch")
        tree = tree.join(named, ["_host", "_node", "_seg"], "left").withColumn("_node", F.when(F.col("_seg").isNull(), F.col("_node")).otherwise(F.concat("_node", F.lit("/"), "_branch"))).drop("_seg", "_branch")
        tree = materialize(tree, f"url-tree-{level}")
    merged = tree.groupBy("_host", "_node").agg(F.sum("n1").alias("n_labels"), F.sum("b1").alias("_bad"))
    merged = merged.withColumn("bad_share", (F.col("_bad") + prior * p.prior_weight) / (F.col("n_labels") + p.prior_weight))
    least = F.col("bad_share") - p.reject_z * F.sqrt(F.col("bad_share") * (1 - F.col("bad_share")) / (F.col("n_labels") + p.prior_weight + 1))
    merged = merged.withColumn("rejected", (F.col("n_labels") >= p.min_labels) & (least > p.max_odds * prior / (1 - prior + p.max_odds * prior)))
    return tree.join(merged, ["_host", "_node"]).select("_host", "_shape", F.col("_node").alias("template"), "n_labels", "bad_share", "rejected")


def side_of(page: Column) -> Column:
    """0 or 1: whether a page's label groups or judges."""
    return F.pmod(F.xxhash64(page), F.lit(2)).cast("int")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], p: TreeParams = TreeParams(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict and template of every row of pages.

    labels has (id_col, bad): 1 or 0 for pages that are labelled; of several
    rows for one page the worst counts.  A null URL, or one without "://", has
    an empty host and path and belongs to the template of those.  Segments of
    over 40 characters are variable, so long URLs don't widen the tree; children
    of equal shares are in one bin and merged.  Repeated rows
    are judged each, an empty table gives no rows, other columns aren't read.
    """
    lab = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max("bad").cast("int").alias("_bad"))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_u"))
    rows = rows.select("_id", F.coalesce(host_of(F.col("_u")), F.lit("")).alias("_host"), F.coalesce(path_of(F.col("_u")), F.lit("")).alias("_path")).withColumn("_shape", shape(F.col("_path"), p.depth))
    tree = materialize(build_tree(rows.join(lab, "_id", "left").select("_host", "_shape", "_bad", side_of(F.col("_id")).alias("_side")), p), "url-templates")
    # Only rejected templates are joined back; Spark broadcasts that table below its size threshold, else AQE splits a hot host.
    out = rows.join(tree.where("rejected").select("_host", "_shape", "template", F.lit(True).alias("_no")), ["_host", "_shape"], "left")
    by_rule = rule_of(F.col("_host"), F.col("_path"), rules)
    return out.withColumn("_rule", by_rule).select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_no"), "block").otherwise("allow")).alias("verdict"), F.col("template").alias("rejected_template"),
    )
