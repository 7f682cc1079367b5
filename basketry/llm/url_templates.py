"""URL filters: host and path rules, then a path-template tree per host; DataFrame functions only.

The tree: paths are cut into segments, digit runs generalise to ``#`` and the
distinct (host, segments) are counted once with their labels, before any
further shuffle. Level by level, a child becomes part of its node's wildcard
``*`` when its shares of bad and good labels do not differ from those of its
siblings together (two two-proportion tests at ``z``); a child that differs
stays a branch of its own, however many siblings there are. The leaves are
templates; one is rejected when
its smoothed labelled purity (bad + strength * prior) / (bad + good +
strength) reaches ``reject_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored

DEPTH = 4  # levels of the tree; the segments below the last level form one
MAX_INLINE_RULES = 256  # more rules than this are joined instead of compiled
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://``; host in lower case; both empty without it or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _rule_parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def _ordered(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest rule first; of equal rules ``block`` first."""
    return sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0] != "block"))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str]], max_inline: int = MAX_INLINE_RULES) -> DataFrame:
    """``pages`` (with ``host`` and ``path``) plus ``rule`` and ``rule_verdict``; null where no rule fits.

    ``rules`` are (verdict, ``host/path``) pairs. A rule fits its host and all
    subdomains when the page's path starts with the rule's; the longest wins,
    then ``block``. Up to ``max_inline`` rules are compiled into one
    expression; a longer list is joined on the host's suffixes.
    """
    rules = _ordered(rules)
    if len(rules) <= max_inline:
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for v, r in reversed(rules):
            host, path = _rule_parts(r)
            fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
            rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
        return pages.withColumns({"rule": rule, "rule_verdict": verdict})
    spark = pages.sparkSession
    listed = spark.createDataFrame(
        [(i, v, r, *_rule_parts(r)) for i, (v, r) in enumerate(rules)], "rank int, v string, r string, rh string, rp string"
    )
    # distinct (host, path) first, so a hot page is matched once
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    hits = (
        places.select("host", "path", F.explode(tails).alias("rh"))
        .join(listed, "rh")
        .where(F.startswith("path", F.col("rp")))
        .groupBy("host", "path")
        .agg(F.min(F.struct("rank", "r", "v")).alias("best"))
        .select("host", "path", F.col("best.r").alias("rule"), F.col("best.v").alias("rule_verdict"))
    )
    return pages.join(hits, ["host", "path"], "left")


def segments(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path with digit runs as ``#``; segments from ``depth`` on are one."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "#"), "/")
    last = F.array_join(F.slice(parts, depth, F.greatest(F.size(parts) - depth + 1, F.lit(0))), "/")
    return F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth - 1), F.array(last))).otherwise(parts)


def template_tree(
    pages: DataFrame, label: str = "bad", depth: int = DEPTH, z: float = 3.0
) -> DataFrame:
    """(host, segs, template, n, bad, good): the template of every distinct (host, segments).

    ``pages`` has ``host``, ``segs`` and the label column (true: bad, false:
    good, null: none). ``n``, ``bad`` and ``good`` count the pages of this
    (host, segments).
    """
    bad = F.col(label)
    tree = pages.groupBy("host", "segs").agg(
        F.count("*").alias("n"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(~bad, 1).otherwise(0)).alias("good"),
    )
    tree = stored(tree.withColumn("template", F.lit("")), "url-tree")

    def apart(hits: str, all_hits: str) -> Column:
        """Two-proportion test of a child against its siblings together."""
        rest, rest_hits = F.col("N") - F.col("cn"), F.col(all_hits) - F.col(hits)
        pooled = F.col(all_hits) / F.col("N")
        err = F.sqrt(pooled * (1 - pooled) * (1 / F.col("cn") + F.try_divide(F.lit(1), rest)))
        gap = F.abs(F.col(hits) / F.col("cn") - F.try_divide(rest_hits, rest))
        return F.coalesce((err > 0) & (gap > z * err), F.lit(False))  # no sibling: nothing to tell apart

    for level in range(depth):
        token = F.when(F.size("segs") > level, F.get("segs", F.lit(level)))
        at = tree.withColumn("token", token)
        children = (
            at.where("token is not null")
            .groupBy("host", "template", "token")
            .agg(F.sum("n").alias("cn"), F.sum("bad").alias("cb"), F.sum("good").alias("cg"))
        )
        parents = children.groupBy("host", "template").agg(
            F.count("*").alias("kids"), F.sum("cn").alias("N"), F.sum("cb").alias("B"), F.sum("cg").alias("G")
        )
        judged = children.join(parents, ["host", "template"]).select(
            "host",
            "template",
            "token",
            F.when((F.col("kids") > 1) & ~(apart("cb", "B") | apart("cg", "G")), F.lit("*"))
            .otherwise(F.col("token"))
            .alias("shown"),
        )
        tree = at.join(judged, ["host", "template", "token"], "left").select(
            "host",
            "segs",
            "n",
            "bad",
            "good",
            F.when(F.col("shown").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), "shown"))
            .alias("template"),
        )
        tree = stored(tree, "url-tree")
    return tree


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label: Column | None = None,
    strength: float = 5.0,
    prior: float = 0.2,
    reject_at: float = 0.8,
    z: float = 3.0,
    max_inline: int = MAX_INLINE_RULES,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``.

    A page that a rule fits gets the rule's verdict; any other is blocked when
    its template's purity reaches ``reject_at``. ``label`` (a boolean column
    over ``pages``, true for bad) trains the tree; by default the rules'
    verdicts do. Null urls, and urls without ``://``, have empty host and path
    and share one template; repeated rows and null ids stay; other columns are
    ignored; an empty table gives no rows.
    """
    host, path = split_url(F.col(f"`{url_col}`").cast("string"))
    given = pages.select(
        F.col(f"`{id_col}`").alias("_id"),
        host.alias("host"),
        path.alias("path"),
        (F.lit(None).cast("boolean") if label is None else label).alias("bad"),
    )
    ruled = apply_rules(given, rules, max_inline)
    if label is None:
        ruled = ruled.withColumn("bad", F.col("rule_verdict") == "block")
    ruled = ruled.withColumn("segs", segments(F.col("path")))
    tree = template_tree(ruled, "bad", DEPTH, z)
    sums = tree.groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    purity = (F.col("b") + F.lit(strength * prior)) / (F.col("b") + F.col("g") + F.lit(strength))
    found = tree.select("host", "segs", "template").join(
        sums.select("host", "template", purity.alias("purity")), ["host", "template"]
    )
    return ruled.join(found, ["host", "segs"]).select(
        F.col("_id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("purity") >= reject_at, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
        "purity",
    )
