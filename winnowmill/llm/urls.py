"""URL filter: allow and block rules, and per host a tree of path templates judged by labelled purity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import attach_group_values
from .common import col, stored

#: Where most distinct segments have one page, those with fewer pages than this are chance repeats of ids.
MIN_PAGES = 5
#: Weight, in labelled pages, of the parent's purity in that of a node.
PRIOR_PAGES = 10.0
#: A branch whose share of bad pages differs from that of a group by fewer standard errors may join it.
SIMILAR = 2.58
#: With fewer labelled pages nothing differs by SIMILAR; such a branch stays by itself, with its parent's purity.
MIN_LABELLED = 4
#: Shares of bad pages are told apart in steps of one in so many, so that a node has few to compare.
STEPS = 64
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host and path of a url; both empty for null and without "://"."""
    found = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substr(url, F.locate("://", url) + F.lit(3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(found, lower).otherwise(""), F.when(found, path).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict, for rules (verdict, host + path); null if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's path.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _purity(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + prior * PRIOR_PAGES) / (labelled + PRIOR_PAGES)


def _escaped(segment: Column) -> Column:
    for sign, code in (("%", "%25"), ("*", "%2A"), ("|", "%7C")):
        segment = F.replace(segment, F.lit(sign), F.lit(code))
    return segment


def _differ(one: Column, two: Column) -> Column:
    """Whether the shares of bad pages of two ``(labelled, bads)`` differ significantly."""
    n, m = one["labelled"], two["labelled"]
    pooled = (one["bads"] + two["bads"]) / (n + m)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return F.abs(one["bads"] / n - two["bads"] / m) > error * SIMILAR


def _grouped(steps: Column) -> Column:
    """``(step, labelled, bads)`` in order of step -> groups ``(first, last, labelled, bads)`` of similar ones.

    The next step joins a group as long as neither it nor the group's first step then differs from the whole.
    """
    sums = lambda x: F.struct(x["labelled"].alias("labelled"), x["bads"].alias("bads"))
    alone = lambda x: F.struct(
        x["step"].alias("first"), x["step"].alias("last"), x["labelled"].alias("labelled"), x["bads"].alias("bads"), sums(x).alias("start")
    )

    def add(groups: Column, x: Column) -> Column:
        last = F.element_at(groups, -1)
        whole = F.struct((last["labelled"] + x["labelled"]).alias("labelled"), (last["bads"] + x["bads"]).alias("bads"))
        joined = F.struct(last["first"].alias("first"), x["step"].alias("last"), whole["labelled"].alias("labelled"),
                          whole["bads"].alias("bads"), last["start"].alias("start"))
        begins = _differ(sums(x), whole) | _differ(last["start"], whole)
        grown = F.concat(F.slice(groups, F.lit(1), F.size(groups) - 1), F.array(joined))
        return F.when(begins, F.concat(groups, F.array(alone(x)))).otherwise(grown)

    first = F.array(alone(F.element_at(steps, 1)))
    return F.aggregate(F.slice(steps, F.lit(2), F.greatest(F.size(steps) - 1, F.lit(0))), first, add)


def _branches(children: DataFrame) -> DataFrame:
    """``(node, segment, branch, branch_purity)``: the branch of each segment below each node.

    ``children`` has ``(node, segment, n, labelled, bads, parent)``. The row with a null segment is the wildcard,
    which has the segments that are taken for a variable. Branches are compared by the share of bad pages in
    STEPS steps, so no node brings more than these into one row, however many segments it has.
    """
    ids = children.groupBy("node").agg((F.avg((F.col("n") == 1).cast("int")) > 0.5).alias("ids"), F.count("*").alias("rows"))
    known = attach_group_values(children, ids, "node", "rows", "segment")
    share = (F.col("n") >= MIN_PAGES) | ((F.col("n") > 1) & ~F.col("ids"))
    known = known.withColumn("literal", F.when(share, F.col("segment")))
    named = known.groupBy("node", "literal").agg(
        F.sum("labelled").alias("labelled"), F.sum("bads").alias("bads"), F.max("parent").alias("parent")
    )
    step = F.when(F.col("labelled") >= MIN_LABELLED, F.round(F.col("bads") / F.col("labelled") * STEPS).cast("int"))
    named = stored(named.withColumn("step", step), "url-branches")
    # The names of a group are its first one and how many more there are.
    steps = named.where("step IS NOT NULL").groupBy("node", "step").agg(F.sum("labelled").alias("labelled"), F.sum("bads").alias("bads"))
    entry = F.struct("step", "labelled", "bads")
    groups = steps.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("steps"))
    groups = groups.select("node", F.explode(_grouped(F.col("steps"))).alias("g"))
    groups = groups.select("node", "g.labelled", "g.bads", "g.first", F.explode(F.sequence("g.first", "g.last")).alias("step"))
    groups = groups.select(*[F.col(c).alias(f"g_{c}") for c in ("node", "step", "first", "labelled", "bads")])
    of_step = (F.col("node") == F.col("g_node")) & (F.col("step") == F.col("g_step"))
    placed = named.join(groups, of_step, "left").drop("g_node", "g_step")
    name = F.coalesce(_escaped(F.col("literal")), F.lit("*"))
    names = placed.where("g_first IS NOT NULL").groupBy("node", "g_first").agg(F.min(name).alias("least"), (F.count("*") - 1).alias("more"))
    names = names.select(F.col("node").alias("n_node"), F.col("g_first").alias("n_first"), "least", "more")
    of_group = (F.col("node") == F.col("n_node")) & (F.col("g_first") == F.col("n_first"))
    placed = placed.join(names, of_group, "left")
    several = F.when(F.col("more") > 0, F.concat("least", F.lit("|%+"), "more")).otherwise(F.col("least"))
    branch = F.struct(
        F.coalesce(several, name).alias("branch"),
        F.coalesce(_purity(F.col("g_bads"), F.col("g_labelled"), F.col("parent")), F.col("parent")).alias("branch_purity"),
    )
    placed = placed.select(F.col("node").alias("b_node"), F.col("literal").alias("b_literal"), branch.alias("found"))
    same = (F.col("node") == F.col("b_node")) & F.col("literal").eqNullSafe(F.col("b_literal"))
    return known.select("node", "segment", "literal").join(placed, same).select("node", "segment", "found.branch", "found.branch_purity")


def path_templates(pages: DataFrame) -> DataFrame:
    """``(host, path, template, purity)`` for every different host and path of ``(host, path, bad)``.

    ``bad`` is 1, 0 or null (no label). Level by level, from each host's root: the segments below a node are
    counted. Those of one page only and, where these are most, those of fewer than MIN_PAGES are taken for
    a variable and become one wildcard; all others stay, however many a node has. Branches are put in order
    of their share of bad pages and merged into groups of similar ones; those with fewer than MIN_LABELLED
    labelled pages stay by themselves and have their parent's purity. A group's purity is its share of bad
    labelled pages, smoothed towards its parent's, the root's towards that of all pages.

    Pages are counted by host and path first. A node below which all paths are alike is not opened, so the
    levels end with the deepest node that branches.
    """
    labels = [F.count("bad").cast("double").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).cast("double").alias("bads")]
    paths = pages.groupBy("host", "path").agg(F.count("*").alias("n"), *labels)
    split = F.split("path", "/")
    # A path begins with a slash, so the first part is empty; one without is taken whole.
    segments = F.when(F.col("path").startswith("/"), F.slice(split, 2, F.size(split))).otherwise(split)
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(segments)
    rows = stored(paths.withColumn("rest", segments), "url-paths")
    sums = [F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bads").alias("bads")]
    total = rows.agg(*sums).first()
    prior = (total["bads"] or 0.0) / total["labelled"] if total["labelled"] else 0.0
    roots = rows.groupBy("host").agg(*sums, F.count("*").alias("rows"))
    roots = roots.select("host", "rows", _purity(F.col("bads"), F.col("labelled"), F.lit(prior)).alias("purity"))
    rows = attach_group_values(rows, roots, "host", "rows", "path").drop("rows").withColumn("template", F.lit(""))
    done, node = None, F.xxhash64("host", "template")
    while True:
        rows = rows.withColumn("node", node)
        alike = rows.groupBy("node").agg(F.min("rest").alias("low"), F.max("rest").alias("high"), F.count("*").alias("rows"))
        alike = alike.select("node", "rows", (F.col("low") < F.col("high")).alias("open"))
        rows = stored(attach_group_values(rows, alike, "node", "rows", "path").drop("rows"), "url-level")
        ended = ~F.col("open") | (F.size("rest") == 0)
        leaves = rows.where(ended).select("host", "path", "template", "purity")
        done = leaves if done is None else done.unionByName(leaves)
        rows = rows.where(~ended).withColumn("segment", F.element_at("rest", 1))
        if rows.isEmpty():
            return done
        children = rows.groupBy("node", "segment").agg(*sums, F.max("purity").alias("parent"), F.count("*").alias("rows"))
        children = stored(children, "url-children")
        found = _branches(children.drop("rows")).join(
            children.select(F.col("node").alias("c_node"), F.col("segment").alias("c_segment"), "rows"),
            (F.col("node") == F.col("c_node")) & (F.col("segment") == F.col("c_segment")),
        )
        found = found.select(F.struct("node", "segment").alias("place"), "branch", "branch_purity", "rows")
        rows = attach_group_values(rows.withColumn("place", F.struct("node", "segment")), found, "place", "rows", "path")
        rows = rows.select(
            "host", "path", "n", "labelled", "bads", F.slice("rest", F.lit(2), F.size("rest") - 1).alias("rest"),
            F.concat("template", F.lit("/"), "branch").alias("template"), F.col("branch_purity").alias("purity"),
        )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``(id, host, path, rule, verdict, template, purity)`` for every page.

    ``labels`` are ``(host, path, bad)`` rows, 1 for bad and 0 for good, that judge urls by their host
    and path; several for one are joined to bad if any is. The longest rule that fits decides; else the
    page is blocked if the purity of its template, the smoothed share of bad labelled pages, is at least
    REJECT. Pages without host share the root of the empty host. Rows are neither dropped nor merged;
    repeated urls count as often as they occur. An empty table gives an empty result.
    """
    host, path = host_and_path(col(url_col))
    rows = pages.select(col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = stored(rows.withColumn("place", F.struct("host", "path")), "url-rows")
    judged = labels.groupBy("host", "path").agg(F.max("bad").alias("bad"))
    counts = rows.groupBy("place").agg(F.count("*").alias("rows"))
    judged = counts.join(judged.select(F.struct("host", "path").alias("of"), "bad"), F.col("place") == F.col("of")).drop("of")
    known = attach_group_values(rows, judged, "place", "rows", "id")
    templates = path_templates(known.select("host", "path", "bad"))
    templates = templates.select(F.struct("host", "path").alias("place"), "template", "purity").join(counts, "place")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    pure = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return attach_group_values(rows, templates, "place", "rows", "id").select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, pure).alias("verdict"),
        "template", "purity",
    )
