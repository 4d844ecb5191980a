"""URL filtering by a tree of path templates.

Each host's paths form a tree of segments. Variable segments become wildcards,
first by form (numbers, long hexadecimal names, with or without an extension),
then by counts: a node whose children are many and rarely repeated gets one
wildcard child instead. Sibling branches whose share of rejected labels cannot
be told apart from that of all siblings are merged; a branch without labels joins
them if at least two of its siblings have labels and no labelled one stands out.
Each resulting template has a smoothed purity (labelled rejections over labels,
pulled towards the host's rate, which is pulled towards the rate of all), and is
rejected above a threshold. A template without labels is not rejected.

Labels are a column if there is one; else the URLs that a rule decides teach
the templates. Rules come first: the longest that fits decides, and the
template decides the rest. All of it is DataFrame work on the aggregated
templates; no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.frames import Shielded
from corpusmill.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MANY_CHILDREN = 20  # a node with more children than this ...
RARE = 4.0  # ... that have fewer rows than this on average has one wildcard child
SMOOTHING = 4.0
THRESHOLD = 0.5
ALIKE_Z = 2.0  # standard errors within which a branch is like its siblings
BROADCAST_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are empty for
    a null url and one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, UPPER.lower()), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (of equals the one that sorts first) that fits, and its verdict; null without one.

    ``rules`` are (verdict, ``host/path``): a rule fits its host and all
    subdomains if the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):  # later ones win
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def form(segment: Column) -> Column:
    """A segment with what varies by form replaced by a wildcard."""
    out = F.regexp_replace(segment, r"^[0-9]+(\.[A-Za-z]{1,5})?$", r"{n}$1")
    return F.regexp_replace(out, r"^[0-9a-fA-F-]{8,}(\.[A-Za-z]{1,5})?$", r"{h}$1")


def _rate(bad: Column, n: Column, prior: Column) -> Column:
    return (bad + F.lit(SMOOTHING) * prior) / (n + F.lit(SMOOTHING))


def template_tree(shapes: DataFrame) -> DataFrame:
    """``shapes`` has a row for each (``host``, ``segments`` by form) with its
    ``rows``, ``labelled`` and ``bad`` labels; adds ``template``, its number of
    ``labels`` and its ``purity``."""
    shapes = shapes.withColumn("shape", F.array_join("segments", "/"))
    # counts: which nodes have many rare children
    nodes = shapes.select("host", "rows", "segments", F.posexplode("segments").alias("level", "segment"))
    nodes = nodes.withColumn("parent", F.array_join(F.expr("slice(segments, 1, level)"), "/"))
    children = nodes.groupBy("host", "parent", "level", "segment").agg(F.sum("rows").alias("rows"))
    wide = children.groupBy("host", "parent", "level").agg(F.count(F.lit(1)).alias("children"), F.sum("rows").alias("rows"))
    wide = wide.filter((F.col("children") > MANY_CHILDREN) & (F.col("rows") < RARE * F.col("children"))).select("host", "parent", "level", F.lit(True).alias("wide"))
    named = nodes.join(wide, ["host", "parent", "level"], "left")
    named = named.withColumn("name", F.when(F.col("wide"), F.lit("{*}")).otherwise(F.col("segment")))
    named = named.withColumn("shape", F.array_join("segments", "/"))
    named = named.groupBy("host", "shape").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "name"))), lambda x: x["name"]).alias("names"))
    tree = shapes.join(named, ["host", "shape"], "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    # the branch: the last segment that is not a wildcard; its siblings differ there only
    last = F.expr("array_max(transform(sequence(0, size(names)), i -> if(i > 0 and not startswith(element_at(names, greatest(i, 1)), '{'), i, 0)))")
    tree = tree.withColumn("last", F.when(F.size("names") > 0, last).otherwise(F.lit(0)))
    tree = tree.withColumn("siblings", F.array_join(F.expr("transform(names, (x, i) -> if(i + 1 = last, '{~}', x))"), "/"))
    own = tree.withColumn("own", F.array_join("names", "/")).groupBy("host", "siblings", "own").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    family = Window.partitionBy("host", "siblings")
    own = own.withColumn("fn", F.sum("n").over(family)).withColumn("fb", F.sum("b").over(family)).withColumn("members", F.count(F.lit(1)).over(family))
    p = F.when(F.col("fn") > 0, F.col("fb") / F.col("fn")).otherwise(F.lit(0.0))
    error = F.sqrt(p * (1 - p) / F.col("n") + F.lit(0.25) / (F.col("n") * F.col("n")))
    own = own.withColumn("unlike", F.when(F.col("n") > 0, (F.abs(F.col("b") / F.col("n") - p) > ALIKE_Z * error).cast("int")))
    # a branch without labels joins a family whose labelled branches, two at least, are all alike
    uniform = (F.count("unlike").over(family) > 1) & (F.max("unlike").over(family) == 0)
    own = own.withColumn("uniform", uniform)
    joins = (F.col("members") > 1) & F.when(F.col("n") > 0, F.col("unlike") == 0).otherwise(F.col("uniform"))
    own = own.withColumn("template", F.when(joins, F.col("siblings")).otherwise(F.col("own")))
    # smoothed purity, level by level: all, host, template
    every = tree.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("n")).first()
    base = F.lit(((every.b or 0) + 0.5) / ((every.n or 0) + 1.0))
    hosts = own.groupBy("host").agg(F.sum("b").alias("hb"), F.sum("n").alias("hn"))
    hosts = hosts.select("host", _rate(F.col("hb"), F.col("hn"), base).alias("host_rate"))
    merged = own.groupBy("host", "template").agg(F.sum("b").alias("tb"), F.sum("n").alias("tn")).join(hosts, "host")
    merged = merged.select("host", "template", F.col("tn").alias("labels"), _rate(F.col("tb"), F.col("tn"), F.col("host_rate")).alias("purity"))
    own = own.select("host", "siblings", "own", "template").join(merged, ["host", "template"])
    tree = tree.withColumn("own", F.array_join("names", "/")).join(own, ["host", "siblings", "own"])
    return tree.select("host", "shape", "template", "labels", "purity")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", label: str | None = None) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` (null without one), ``template``
    with its number of ``labels`` and its ``purity`` (smoothed share of rejections),
    and ``verdict``.

    ``label`` names a column with 1 for pages known to be rejected and 0 for pages
    known to be good; without it the rules' verdicts are the labels. Null and
    malformed urls have an empty host and the empty template; without any label
    nothing but a rule blocks. Repeated rows get equal results; an empty table
    gives an empty result. Columns of ``pages`` with the names of the new ones are
    replaced. The templates are counted when this is called and written to the
    shared checkpoint folder; judging the pages is lazy."""
    side = Shielded(pages)
    host, path = host_and_path(F.col(side.col(url)).cast("string"))
    rows = side.df.withColumn("_host", host).withColumn("_path", path)
    rule, said = matching_rule(F.col("_host"), F.col("_path"), rules)
    rows = rows.withColumn("_rule", rule).withColumn("_said", said)
    segments = F.transform(F.filter(F.split("_path", "/"), lambda s: s != ""), form)
    known = F.when(F.col("_said") == "block", 1).when(F.col("_said") == "allow", 0) if label is None else F.col(side.col(label)).cast("int")
    rows = rows.withColumn("_segments", segments).withColumn("_shape", F.array_join("_segments", "/"))
    shapes = rows.groupBy(F.col("_host").alias("host"), F.col("_segments").alias("segments")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(known).alias("labelled"), F.coalesce(F.sum(known), F.lit(0)).alias("bad")
    )
    tree = materialize(template_tree(materialize(shapes, "url-shapes")), "url-templates").withColumnRenamed("host", "_th").withColumnRenamed("shape", "_ts")
    if tree.count() <= BROADCAST_ROWS:
        tree = F.broadcast(tree)
    judged = rows.join(tree, (F.col("_host") == F.col("_th")) & (F.col("_shape") == F.col("_ts")), "left")
    by_template = F.when((F.col("labels") > 0) & (F.col("purity") > THRESHOLD), F.lit("block")).otherwise(F.lit("allow"))
    new = {"host": F.col("_host"), "path": F.col("_path"), "rule": F.col("_rule"), "template": F.col("template"), "labels": F.col("labels"), "purity": F.col("purity"), "verdict": F.coalesce(F.col("_said"), by_template)}
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in new]
    return judged.select(*own, *[c.alias(n) for n, c in new.items()])
