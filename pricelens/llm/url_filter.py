"""URL filter: listed rules, and a tree of path templates per host for the rest.

Rules (host, path prefix, verdict) fit a host and all its subdomains, and urls whose
path starts with the rule's; the longest fitting rule wins: the longest host, of
those the longest path, of equal ones block.

Where no rule fits, the method decides.  The segments of a path, of each host, form
a tree:

1. Segments that are numbers, long hexadecimal or mixed codes become wildcards that
   keep the file ending (``*``, ``*.html``).
2. A node with more than ``fan_out`` different children, or with more than half as
   many as it has urls, is variable: its children become one wildcard.  Levels are
   handled from the root down, each from per-node counts.
3. Sibling branches below a node, with the same path after them, whose labelled shares
   of bad urls don't differ from that of the others (two-proportion z below ``z_merge``)
   are merged into one branch, at every node, from the root down to the deepest path.
4. A template is rejected (block) if its smoothed purity of bad urls,
   (bad + prior * strength) / (labelled + strength), is at least ``reject``; prior is
   the share of bad urls among all labelled ones.

All counts cover all urls and are combined before the shuffles, so a host with a
third of the pages is only a third of the counts' input; children are compared with
their parent's total, never with one another.

Defined cases: a null url or one without ``://`` has an empty host and path; it has
no rule and the verdict allow; urls without a path form their host's root template;
repeated rows are judged each; null labels are passed over; without labels nothing
is rejected; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, sized_join, written

#: host, path prefix (without the first slash), verdict
RULES = (("net", "", "block"), ("example.net", "en/", "allow"), ("example.com", "de/", "block"), ("org", "fr/", "allow"))
FAN_OUT = 64
Z_MERGE = 2.0
STRENGTH = 20.0
REJECT = 0.6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The winning rule's name (host/path) and its verdict, null without one.  The
    rules are a parameter, tried from the longest host and path to the shortest."""
    order = sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r[2] != "block", r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(order):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name, verdict = F.when(fits, f"{h}/{p}").otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> Column:
    """Path segments with codes generalised; a trailing slash doesn't count."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    ending = lambda s: F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
    code = lambda s: s.rlike(r"^(?:\d+|[0-9a-fA-F]{8,}|(?=.*\d)[\w-]{12,})(?:\.[A-Za-z]{1,5})?$")
    return F.transform(parts, lambda s: F.when(code(s), F.concat(F.lit("*"), ending(s))).otherwise(s))


def templates(urls: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """Distinct (host, segments) of ``urls`` (host, path, bad: null, 0 or 1) with their
    template and counts: host, path template, n, labelled, bad.

    One row per distinct generalised path; level by level its segment is kept or, if
    the node above is variable, replaced, down to the deepest path."""
    rows = urls.select("host", _segments(F.col("path")).alias("seg"), "bad")
    rows = cut(rows.groupBy("host", "seg").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    rows = rows.withColumn("node", F.lit(""))
    deepest = rows.agg(F.max(F.size("seg"))).first()[0] or 0
    for level in range(deepest):
        child = F.when(F.size("seg") > level, F.col("seg")[level])
        rows = rows.withColumn("child", child)
        seen = rows.where("child is not null").groupBy("host", "node", "child").agg(F.sum("n").alias("n"))
        fan = seen.groupBy("host", "node").agg(F.count("*").alias("children"), F.sum("n").alias("urls"))
        variable = cut(fan.where((F.col("children") > fan_out) | ((F.col("children") > 8) & (F.col("children") * 2 > F.col("urls")))).select("host", "node", F.lit(True).alias("variable")))
        rows = rows.join(variable, ["host", "node"], "left")
        step = F.when(F.col("variable") & ~F.col("child").startswith("*"), F.lit("*")).otherwise(F.col("child"))
        rows = cut(rows.withColumn("node", F.when(F.col("child").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), step))).select("host", "seg", "n", "labelled", "bad", "node"))
    return rows.withColumnRenamed("node", "template")


def merged(paths: DataFrame, z_merge: float = Z_MERGE) -> DataFrame:
    """Branches merged below each node: adds ``branch``, the template with each segment
    replaced by ``{*}`` that has siblings (below the same, already merged node, with the
    same path after it) and whose share of bad urls is like that of the siblings."""
    rows = paths.groupBy("host", "template").agg(F.sum("labelled").alias("m"), F.sum("bad").alias("b"))
    rows = cut(rows.withColumns({"parts": F.filter(F.split("template", "/"), lambda s: s != ""), "node": F.lit("")}))
    deepest = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    keys = ["host", "node", "tail"]
    for level in range(deepest):
        here = F.size("parts") > level
        tail = F.when(here, F.concat_ws("/", F.slice("parts", level + 2, deepest)))
        rows = rows.withColumns({"head": F.when(here, F.col("parts")[level]), "tail": tail})
        per = rows.where("head is not null").groupBy(*keys, "head").agg(F.sum("m").alias("own_m"), F.sum("b").alias("own_b"))
        all_ = per.groupBy(*keys).agg(F.sum("own_m").alias("all_m"), F.sum("own_b").alias("all_b"), F.count("*").alias("siblings")).where("siblings > 1")
        m, b = F.col("own_m"), F.col("own_b")
        rest_m, rest_b = F.col("all_m") - m, F.col("all_b") - b
        pooled = F.when(F.col("all_m") > 0, F.col("all_b") / F.col("all_m")).otherwise(F.lit(0.0))
        spread = F.sqrt(pooled * (1 - pooled) * (F.when(m > 0, 1 / m) + F.when(rest_m > 0, 1 / rest_m)))
        differs = F.when(m > 0, F.abs(b / m - F.when(rest_m > 0, rest_b / rest_m)) > F.lit(z_merge) * spread)
        like = per.join(all_, keys).where(~F.coalesce(differs, F.lit(False))).select(*keys, "head", F.lit(True).alias("like"))
        rows = rows.join(like, [*keys, "head"], "left")
        step = F.when(F.col("like"), F.lit("{*}")).otherwise(F.col("head"))
        node = F.when(F.col("head").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), step))
        rows = cut(rows.select("host", "template", "m", "b", "parts", node.alias("node")))
    return sized_join(paths, rows.select("host", "template", F.col("node").alias("branch")), ["host", "template"])


def judged_templates(urls: DataFrame, fan_out: int = FAN_OUT, z_merge: float = Z_MERGE, strength: float = STRENGTH, reject: float = REJECT) -> DataFrame:
    """host, seg (distinct generalised paths), template, branch, purity, blocked."""
    rows = cut(merged(templates(urls, fan_out), z_merge))
    total = rows.agg(F.sum("labelled").alias("m"), F.sum("bad").alias("b")).first()
    prior = (total["b"] / total["m"]) if total["m"] else 0.0
    branch = rows.groupBy("host", "branch").agg(F.sum("labelled").alias("m"), F.sum("bad").alias("b"))
    purity = (F.col("b") + F.lit(prior * strength)) / (F.col("m") + F.lit(float(strength)))
    branch = branch.select("host", "branch", purity.alias("purity"))
    out = rows.join(branch, ["host", "branch"]).select("host", "seg", "template", "branch", "purity")
    return out.withColumn("blocked", (F.col("purity") >= reject) & F.lit(bool(total["b"])))


def filter_urls(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, **how) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages`` (page_id, url).
    ``labels``: url_key, bad (0 or 1); a url's key is the last number of its path."""
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "listed": verdict})
    if labels is None:
        marked = rows.withColumn("bad", F.lit(None).cast("long"))
    else:
        known = labels.where("url_key is not null and bad is not null").groupBy("url_key").agg(F.max("bad").cast("long").alias("bad"))
        key = F.regexp_extract("path", r"(\d{1,18})[^\d]*$", 1)
        marked = rows.withColumn("url_key", F.when(key != "", key.cast("long"))).join(known, "url_key", "left")
    marked = written(marked.select("page_id", "host", "path", "rule", "listed", "bad"), "urls")
    verdicts = judged_templates(marked.where("host <> ''"), **how).select("host", "seg", "blocked")
    keyed = marked.select("page_id", "host", "path", "rule", "listed", _segments(F.col("path")).alias("seg"))
    out = sized_join(keyed, cut(verdicts), ["host", "seg"], "left")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("listed", method).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: the quality of the document whose id a page's path names; a page whose
    document has quality 0 counts as bad."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("url_key"), (1 - F.col("quality")).alias("bad"))
    return filter_urls(pages, labels)
