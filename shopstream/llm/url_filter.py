"""Operator 12, URL filters: a path-template tree with smoothed labelled purity. DataFrame functions only.

1. Rules (a host with its subdomains and the start of a path) decide first, the longest that fits. What they decide, and a label
   column if there is one, is the evidence that templates are judged by.
2. The segments of every path take their shape (numbers and ids become wildcards), and equal shapes of a host are counted, so
   that all later steps work on distinct shapes, not on rows.
3. Tree, level by level: a segment is a branch of its node if it has ``SUPPORT`` rows and at least one in ``SHARE`` of the node's; all
   others share the wildcard branch. A node so has at most ``SHARE`` named branches, however many values a segment has.
   Named branches that are statistically alike are merged: those next to each other in the order of their label rates whose rates a
   two-proportion test can't tell apart (5 %) and whose next segments are of the same kinds (total variation up to ``KINDS``).
   Branches without labels are merged among themselves only. Segments after the ``LEVELS - 1`` first are one last segment.
4. A template (host and branches) is rejected if its share of bad labels, smoothed by ``PRIOR_ROWS`` rows of the share ``PRIOR``, is
   ``PURITY`` or more. A template without labels is not rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import stored

LEVELS = 4
SUPPORT = 5
SHARE = 50
KINDS = 0.25
CHI_SQUARE = 3.84  # fixed value: one degree of freedom, 5 %
PRIOR = 0.2
PRIOR_ROWS = 4.0
PURITY = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = "://([^/?#]*)([^?#]*)"
NUMBER = "^[0-9]+([.][A-Za-z]+)?$"
ID = "^[0-9A-Fa-f-]*[0-9][0-9A-Fa-f-]*$"
ID_LENGTH = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]], result: int) -> Column:
    """Of the longest ``(verdict, rule)`` that fits its verdict (``result`` 0) or its text (1); null: none fits."""
    out = F
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        of_host, _, start = rule[1].partition("/")
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(f"/{start}")
        out = out.when(fits, F.lit(rule[result]))
    return out if rules else F.lit(None).cast("string")


def shape_of(path: Column) -> Column:
    """The path without its first slash, with numbers and ids among its segments as wildcards."""
    def shape(s: Column) -> Column:
        return (F.when(s.rlike(NUMBER), F.regexp_replace(s, NUMBER, "{n}$1"))
                .when((F.length(s) >= ID_LENGTH) & s.rlike(ID), F.lit("{id}")).otherwise(s))
    return F.array_join(F.transform(F.split(path.substr(F.lit(2), F.length(path)), "/"), shape), "/")


def _segment(level: int) -> Column:
    """Segment of a shape on this level (the last level: all that follow), null where the path has ended."""
    parts = F.split("shape", "/")
    rest = F.when(F.size(parts) >= LEVELS, F.array_join(F.slice(parts, LEVELS, F.greatest(F.size(parts), F.lit(1))), "/"))
    return rest if level == LEVELS else F.get(parts, F.lit(level - 1))


def _next_kinds(level: int) -> list[Column]:
    """Rows whose path ends after this level, and those that go on with a wildcard."""
    after = F.lit(None).cast("string") if level == LEVELS else _segment(level + 1)
    return [F.sum(F.when(after.isNull(), F.col("n")).otherwise(0)).alias("ends"),
            F.sum(F.when(after.startswith("{"), F.col("n")).otherwise(0)).alias("varies")]


def _alike() -> Column:
    """Whether a branch is like the one before it (columns of which end in _0)."""
    def real(c: str) -> Column:
        return F.col(c).cast("double")
    apart = real("bad") * real("labelled_0") - real("bad_0") * real("labelled")
    bad, labelled = real("bad") + real("bad_0"), real("labelled") + real("labelled_0")
    rates = apart * apart * labelled <= F.lit(CHI_SQUARE) * real("labelled") * real("labelled_0") * bad * (labelled - bad)
    ends, varies = (F.abs(real(c) / real("n") - real(f"{c}_0") / real("n_0")) for c in ("ends", "varies"))
    goes_on = F.abs((real("n") - real("ends") - real("varies")) / real("n") - (real("n_0") - real("ends_0") - real("varies_0")) / real("n_0"))
    return rates & (ends + varies + goes_on <= F.lit(2 * KINDS))


def branches(shapes: DataFrame, level: int) -> DataFrame:
    """``(host, node, seg, branch)``: the named branches of all nodes of a level; what isn't there is the wildcard."""
    found = (shapes.withColumn("seg", _segment(level)).where("seg is not null").groupBy("host", "node", "seg")
             .agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), *_next_kinds(level)))
    found = stored(found, "url-segments")
    totals = found.groupBy("host", "node").agg(F.sum("n").alias("all"))
    named = found.join(totals, ["host", "node"]).where(f"n >= {SUPPORT} and n * {SHARE} >= all")
    order = Window.partitionBy("host", "node", F.col("labelled") > 0).orderBy(
        F.col("bad") / F.nullif("labelled", F.lit(0)), F.col("ends") / F.col("n"), F.col("varies") / F.col("n"), "seg")
    columns = ["n", "labelled", "bad", "ends", "varies"]
    before = named.select("*", *[F.lag(c).over(order).alias(f"{c}_0") for c in columns])
    numbered = before.withColumn("run", F.sum(F.when(F.coalesce(_alike(), F.lit(False)), 0).otherwise(1)).over(order))
    merged = numbered.groupBy("host", "node", F.col("labelled") > 0, "run").agg(F.sort_array(F.collect_list("seg")).alias("segs"))  # SHARE at most
    name = F.when(F.size("segs") == 1, F.col("segs")[0]).otherwise(F.concat(F.lit("{"), F.array_join("segs", "|"), F.lit("}")))
    return merged.select("host", "node", F.explode("segs").alias("seg"), name.alias("branch"))


def templates(counted: DataFrame) -> DataFrame:
    """``(host, shape, n, labelled, bad)`` of distinct shapes -> the same with ``node``, the branches the shape falls under."""
    shapes = stored(counted.withColumn("node", F.lit("")), "url-shapes")
    for level in range(1, LEVELS + 1):
        own = shapes.withColumn("seg", _segment(level))
        under = own.join(branches(shapes, level), ["host", "node", "seg"], "left")
        node = F.when(F.col("seg").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), F.coalesce("branch", F.lit("*"))))
        shapes = stored(under.select("host", "shape", "n", "labelled", "bad", node.alias("node")), "url-shapes")
    return shapes


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               label: Column | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template)``, one row per input row.

    ``rules``: ``(allow or block, host/path)``; a rule fits its host and all subdomains if the path starts with the rule's, the
    longest wins and ``rule`` names it. Other rows are blocked where their template is rejected. ``label``: an expression over the columns
    of ``pages``, 1 for bad and 0 for good ones, null for unknown; used for rows that no rule decides.

    A null url, or one without ``://``, has an empty host and path; these share a template. Repeated rows, and rows without an id,
    count and are judged each. Without labels or rules everything is allowed. An empty table gives an empty result.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        (F.lit(None) if label is None else label).cast("int").alias("label"))
    rows = rows.select("page_id", "host", "path", "label", fitting_rule(F.col("host"), F.col("path"), rules, 1).alias("rule"),
                       fitting_rule(F.col("host"), F.col("path"), rules, 0).alias("by_rule"), shape_of(F.col("path")).alias("shape"))
    bad = F.coalesce((F.col("by_rule") == "block").cast("int"), "label")
    counted = rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count(bad).alias("labelled"),
                                                F.coalesce(F.sum(F.when(bad == 1, 1).otherwise(0)), F.lit(0)).alias("bad"))
    found = templates(counted)
    purity = found.groupBy("host", "node").agg(
        ((F.sum("bad") + F.lit(PRIOR * PRIOR_ROWS)) / (F.sum("labelled") + F.lit(PRIOR_ROWS))).alias("purity"))
    judged = stored(found.select("host", "shape", "node").join(purity, ["host", "node"]), "url-templates")
    verdict = F.coalesce("by_rule", F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.concat("host", "node").alias("template"))
