"""URL filters: for each host a tree of path templates, built by aggregation alone, judged by labelled purity.

1. *Shapes*: each url's path is cut into segments; digits, hex strings and the like become typed wildcards at once.
   Pages are summed by (host, shape), so what follows works on shapes, not on pages.
2. *Generalise*, level by level from the root, as deep as there are many shapes: where the children of one prefix are many and mostly rare, the rare
   ones become one wildcard. Counts of (host, prefix, segment) combine before they are shuffled, so a hot host is
   spread over its segments.
3. *Merge*: a template whose labelled rate does not differ significantly from its siblings' joins them.
4. *Judge*: the purity of a template (or of the branch it joined) is smoothed towards its host's, and that towards the whole table's; below
   ``LEAST_PURITY`` the template is rejected.

Rules on hosts and path prefixes come before the method; the longest that fits wins.

Defined cases: a null url, or one without ``://``, has an empty host and path and its own template; pages without
labels take the smoothed rate of what is above them; repeated and null page_ids are judged row by row; a table without any label allows
everything that no rule blocks; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bytesets


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: The production rules. Fixed values.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)

#: A prefix's children are generalised if there are more than so many; then those with a smaller share are rare.
MANY_CHILDREN, RARE_SHARE = 20, 0.02

#: Labels that a rate borrows from the level above.
SMOOTHING = 10.0

#: Normal deviations beyond which two rates differ.
DIFFERENT = 1.96

LEAST_PURITY = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host, r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.host + r.path)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """The path's segments, variable ones as typed wildcards; a file ending is kept."""
    def typed(segment: Column) -> Column:
        ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
        kind = (
            F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}").when(stem.rlike(r"^[0-9]+$"), "{number}")
            .when(stem.rlike(r"^[0-9a-fA-F-]{16,}$"), "{hex}").when(stem.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{12,}$"), "{code}")
            .otherwise(stem))
        return F.concat(kind, ending)

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), typed)


def shapes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, shape, pages, good, bad) summed over pages (host, shape, label_key) with labels (label_key, good)."""
    counted = pages.groupBy("host", "shape", "label_key").agg(F.count("*").alias("pages"))
    marked = counted.join(labels, "label_key", "left")
    return marked.groupBy("host", "shape").agg(
        F.sum("pages").alias("pages"), F.sum(F.when(F.col("good"), F.col("pages")).otherwise(0)).alias("good"),
        F.sum(F.when(~F.col("good"), F.col("pages")).otherwise(0)).alias("bad"))


def generalised(table: DataFrame) -> DataFrame:
    """``table`` (host, shape, pages, ...) with ``template``: rare children of wide prefixes are wildcards.

    Levels are gone through as long as some prefix has more shapes than a wide one has children. A prefix with no
    more of them has no wide prefix below it, so its shapes are finished as they are, however deep they go.
    """
    live = table.withColumn("prefix", F.lit("")).withColumn("rest", F.col("shape"))
    columns = ["host", "shape", "pages", "good", "bad"]
    done = []
    while True:
        crowded = live.groupBy("host", "prefix").agg(F.count("*").alias("shapes")).where(F.col("shapes") > MANY_CHILDREN)
        crowded = crowded.select("host", "prefix", F.lit(True).alias("crowded"))
        split = session.cut_lineage(live.join(crowded, ["host", "prefix"], "left"))
        as_it_is = F.concat("prefix", F.array_join(F.transform("rest", lambda s: F.concat(F.lit("/"), s)), ""))
        done.append(split.where("crowded IS NULL").select(*columns, as_it_is.alias("template")))
        live = split.where("crowded").drop("crowded").withColumn("segment", F.coalesce(F.get("rest", F.lit(0)), F.lit("$")))
        if live.isEmpty():
            break
        children = live.groupBy("host", "prefix", "segment").agg(F.sum("pages").alias("n"))
        wide = children.groupBy("host", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("total")).where(
            F.col("children") > MANY_CHILDREN)
        rare = children.join(wide, ["host", "prefix"]).where(F.col("n") < RARE_SHARE * F.col("total")).select(
            "host", "prefix", "segment", F.lit(True).alias("rare"))
        step = F.when(F.col("rare"), F.lit("{word}")).otherwise(F.col("segment"))
        stepped = live.join(rare, ["host", "prefix", "segment"], "left").withColumn("step", step)
        ended = F.size("rest") == 0
        done.append(stepped.where(ended).select(*columns, F.col("prefix").alias("template")))
        live = stepped.where(~ended).select(
            *columns, F.concat("prefix", F.lit("/"), F.col("step")).alias("prefix"), F.slice("rest", 2, 2**30).alias("rest"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def judged(table: DataFrame) -> DataFrame:
    """``table`` (host, shape, template, good, bad, ...) with ``branch``, ``purity`` and ``verdict``."""
    templates = table.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    templates = templates.withColumn("parent", F.regexp_replace("template", r"/[^/]*$", ""))
    siblings = templates.groupBy("host", "parent").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    both = templates.join(siblings, ["host", "parent"])
    n, others_good = F.col("good") + F.col("bad"), F.col("all_good") - F.col("good")
    m = others_good + F.col("all_bad") - F.col("bad")
    pooled = F.try_divide("all_good", n + m)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), m)))
    z = F.try_divide(F.abs(F.try_divide("good", n) - F.try_divide(others_good, m)), error)
    # Without labels on both sides, or with one kind of label only, nothing tells them apart.
    alike = F.coalesce(z <= DIFFERENT, F.lit(True))
    both = both.withColumn("branch", F.when(alike, F.concat("parent", F.lit("/*"))).otherwise(F.col("template")))
    branches = both.groupBy("host", "branch").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    hosts = branches.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("bad").alias("host_bad"))
    whole = hosts.agg(F.sum("host_good").alias("sum_good"), F.sum("host_bad").alias("sum_bad"))
    # One row, joined by a constant key.
    whole = whole.withColumn("one", F.lit(1))
    prior = F.coalesce(F.try_divide("sum_good", F.col("sum_good") + F.col("sum_bad")), F.lit(1.0))
    host_rate = (F.col("host_good") + SMOOTHING * prior) / (F.col("host_good") + F.col("host_bad") + SMOOTHING)
    purity = (F.col("good") + SMOOTHING * host_rate) / (F.col("good") + F.col("bad") + SMOOTHING)
    rated = branches.join(hosts, "host").withColumn("one", F.lit(1)).join(whole, "one").select("host", "branch", F.round(purity, 9).alias("purity"))
    verdict = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return both.select("host", "template", "branch").join(rated, ["host", "branch"]).select(
        "host", "template", "branch", "purity", verdict.alias("verdict"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url, label_key): host, path, rule, template, purity and verdict.

    ``labels`` has (label_key, good), one row for each key.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "label_key")
    parsed = parsed.withColumn("shape", shape_of(F.col("path")))
    table = session.cut_lineage(generalised(shapes(parsed, labels)))
    verdicts = judged(table)
    of_shape = table.select("host", "shape", "template").join(verdicts, ["host", "template"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parsed.join(of_shape, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("verdict"), F.lit("allow")).alias("verdict"),
        "template", "purity")


def report(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Each page's url is judged. A page is labelled by the document that the last number of its path names."""
    rows = bytesets.only(pages, page_id="bigint", url="string")
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9/]*/?$", 1)
    rows = rows.withColumn("label_key", F.when(number != "", number.cast("bigint")))
    marks = bytesets.only(labels, doc_id="bigint", quality="int", toxic="int").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = marks.groupBy("doc_id").agg((F.min(F.when((F.col("quality") == 1) & ~(F.coalesce(F.col("toxic"), F.lit(0)) == 1), 1).otherwise(0)) == 1).alias("good"))
    return filter_urls(rows, good.withColumnRenamed("doc_id", "label_key"))
