"""URL filters: listed rules first, then per-host trees of path templates judged by the purity of their labelled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, scratch, table

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Below a tree's node, segments vary when there are more than so many different ones, each on fewer than so many pages on average.
VARIED, PAGES_EACH = 16, 4
#: Levels of a tree; the last one takes the rest of a path.
LEVELS = 6
#: Sibling branches of one form are merged where their shares of blocked pages, in BINS steps, differ by fewer deviations.
BINS, DIFFERS = 16, 1.96
#: Weight, in labelled pages, of the prior share; share of blocked pages from which a template is rejected.
PRIOR, PURITY = 4.0, 0.8


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (its host and path joined), and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later, longer rules are asked first
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def segments(shape: Column) -> Column:
    """The segments of a shape, LEVELS at most, the last with the rest of the path, and a sign for the path's end."""
    own = F.filter(F.split(shape, "/"), lambda x: x != "")
    rest = F.array_join(F.slice(own, F.lit(LEVELS), F.greatest(F.size(own), F.lit(1))), "/")
    return F.concat(F.slice(own, 1, LEVELS - 1), F.when(F.size(own) >= LEVELS, F.array(rest)).otherwise(F.array().cast("array<string>")), F.array(F.lit("$")))


def tail(depth: int) -> Column:
    """What lies below a segment, roughly: how many segments follow, 3 at most, and how the last one is written."""
    follow = F.size("own") - (depth + 2)
    last = F.get("own", F.size("own") - 2)
    form = F.when(last == "0", "number").when(F.contains(last, F.lit(".")), "file").otherwise("name")
    return F.when(follow < 0, "$").otherwise(F.concat_ws(" ", F.least(follow, F.lit(3)).cast("string"), form))


def grown(level: DataFrame, depth: int) -> DataFrame:
    """One level more of all trees: level (host, shape, n, blocked, allowed, own, node, template, share) at its next nodes.

    Segments below a node become a wildcard where they vary. Branches below it whose pages mostly have one form of tail are
    compared in the order of their shares of blocked pages: neighbours that don't differ are one node from here on, so that what
    lies below them is generalised together. Branches without labelled pages are one node, with the evidence of all of their
    form. A node's share is that of its evidence, smoothed by the share of the node above it.
    """
    here = ["host", "node"]
    segment = F.get("own", F.lit(depth))
    kinds = level.where(segment != "$").groupBy(*here, segment.alias("segment")).agg(F.sum("n").alias("n"))
    varied = kinds.groupBy(*here).agg(F.count("*").alias("kinds"), F.sum("n").alias("pages"))
    varied = varied.where((F.col("kinds") > VARIED) & (F.col("pages") < PAGES_EACH * F.col("kinds"))).select(*here, F.lit(True).alias("varies"))
    parts = level.join(varied, here, "left").withColumn("part", F.when(F.col("varies") & (segment != "$"), "*").otherwise(segment)).drop("varies")
    m = F.col("blocked") + F.col("allowed")
    tails = parts.groupBy(*here, "part", tail(depth).alias("tail")).agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum(m).alias("m"))
    branches = tails.groupBy(*here, "part").agg(F.max(F.struct("n", "tail"))["tail"].alias("form"), F.sum("b").alias("b"), F.sum("m").alias("m"))
    branches = branches.withColumn("bin", F.when(F.col("m") > 0, F.floor(BINS * F.col("b") / F.col("m"))).otherwise(-1))
    bins = branches.where("bin >= 0").groupBy(*here, "form", "bin").agg(F.sum("b").alias("b"), F.sum("m").alias("m"))
    order = Window.partitionBy(*here, "form").orderBy("bin")  # BINS + 1 rows at most
    step = bins.select("*", F.lag("b").over(order).alias("b0"), F.lag("m").over(order).alias("m0"))
    gap, pooled = F.col("b") / F.col("m") - F.col("b0") / F.col("m0"), (F.col("b") + F.col("b0")) / (F.col("m") + F.col("m0"))
    differs = gap * gap * F.col("m") * F.col("m0") > DIFFERS * DIFFERS * pooled * (1 - pooled) * (F.col("m") + F.col("m0"))
    step = step.select(*here, "form", "bin", "b", "m", F.sum(F.when(differs, 1).otherwise(0)).over(order).alias("cluster"))
    merged = step.groupBy(*here, "form", "cluster").agg(F.sum("b").alias("own_b"), F.sum("m").alias("own_m"))
    labelled = step.select(*here, "form", "bin", "cluster").join(merged, [*here, "form", "cluster"])
    whole = bins.groupBy(*here, "form").agg(F.sum("b").alias("own_b"), F.sum("m").alias("own_m"))
    other = whole.select(*here, "form", F.lit(-1).cast("long").alias("bin"), F.lit(-1).cast("long").alias("cluster"), "own_b", "own_m")
    evidence = branches.select(*here, "part", "form", "bin").join(labelled.unionByName(other), [*here, "form", "bin"], "left")
    joined = parts.join(evidence.select(*here, "part", "form", "cluster", "own_b", "own_m"), [*here, "part"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        "host", "shape", "n", "blocked", "allowed", "own",
        F.concat("node", F.lit("/"), "form", F.lit("#"), F.coalesce("cluster", F.lit(-1)).cast("string")).alias("node"),
        F.when(F.col("part") == "$", F.col("template")).otherwise(F.concat("template", F.lit("/"), "part")).alias("template"),
        ((zero("own_b") + PRIOR * F.col("share")) / (zero("own_m") + PRIOR)).alias("share"),
    )


def template_shares(paths: DataFrame) -> DataFrame:
    """(host, shape, template, share): from counts by host and shape (n, blocked, allowed), the smoothed share of blocked pages.

    A shape is a path whose runs of digits are one sign. All hosts' trees grow level by level (see grown), each level stored;
    a path's share is that of the node where it ends. The first prior is the host's share, smoothed by that of all labelled
    pages. Every step aggregates counts, never pages. An empty table gives no rows; a host without labelled pages has the prior.
    """
    with scratch(paths.sparkSession):
        paths = materialise(paths, "paths")
        sums = [F.sum("blocked").alias("b"), F.sum(F.col("blocked") + F.col("allowed")).alias("m")]
        b, m = paths.agg(*(F.coalesce(c, F.lit(0)) for c in sums)).first()
        base = (b + 1.0) / (m + 2.0)
        hosts = paths.groupBy("host").agg(*sums).select("host", ((F.col("b") + PRIOR * base) / (F.col("m") + PRIOR)).alias("share"))
        level = paths.select("host", "shape", "n", "blocked", "allowed", segments(F.col("shape")).alias("own"), F.lit("").alias("node"), F.lit("").alias("template")).join(hosts, "host")
        out = None
        for depth in range(LEVELS + 1):
            level = materialise(grown(level, depth), "level")
            ended = level.where(F.size("own") == depth + 1).select("host", "shape", "template", "share")
            out = ended if out is None else out.unionByName(ended)
            level = level.where(F.size("own") > depth + 1)
            if level.isEmpty():
                break
        return materialise(out, "shares", lasting=True)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for each row.

    host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; path goes on up to `?`, `#` or the
    end; both are empty without `://` and for null. The longest fitting rule decides. Pages with a rule are the labelled ones
    for the trees; other pages are blocked where their template's smoothed share of blocked pages reaches PURITY, else allowed.

    Pages are counted by host and shape before anything else, so a host with very many pages is no larger than its number of
    shapes. Repeated rows are judged each and count each; an empty table gives no rows; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), verdict.alias("listed"), F.regexp_replace("path", "[0-9]+", "0").alias("shape"))
    count = lambda v: F.sum(F.when(F.col("listed") == v, 1).otherwise(0))
    paths = parsed.groupBy("host", "shape").agg(F.count("*").alias("n"), count("block").alias("blocked"), count("allow").alias("allowed"))
    shares = template_shares(paths)
    learnt = F.when(F.col("share") >= PURITY, "block").otherwise("allow")
    return parsed.join(shares, ["host", "shape"], "left").select("page_id", "host", "path", "rule", F.coalesce("listed", learnt).alias("verdict"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, by the listed rules and the trees."""
    return judge_urls(table(spark, sf_dir, "pages"))


def _level_sql(d: int) -> str:
    """One level of the trees: from l<d> (host, shape, own, n, b, a, node, share) to l<d + 1>."""
    seg = f"own[{d + 1}]"
    return f"""
k{d} AS (SELECT host, node FROM (SELECT host, node, {seg} AS g, sum(n) AS n FROM l{d} WHERE {seg} <> '$' GROUP BY ALL) GROUP BY ALL HAVING count(*) > {VARIED} AND sum(n) < {PAGES_EACH} * count(*)),
q{d} AS (SELECT l.*, CASE WHEN k.host IS NOT NULL AND {seg} <> '$' THEN '*' ELSE {seg} END AS part,
         CASE WHEN len(own) < {d + 2} THEN '$' ELSE least(len(own) - {d + 2}, 3) || ' ' || CASE WHEN own[-2] = '0' THEN 'number' WHEN contains(own[-2], '.') THEN 'file' ELSE 'name' END END AS tail
         FROM l{d} l LEFT JOIN k{d} k ON l.host = k.host AND l.node = k.node),
f{d} AS (SELECT host, node, part, max(ROW(n, tail)) AS top, sum(b) AS b, sum(m) AS m FROM (SELECT host, node, part, tail, sum(n) AS n, sum(b) AS b, sum(b + a) AS m FROM q{d} GROUP BY ALL) GROUP BY ALL),
e{d} AS (SELECT host, node, part, top[2] AS form, b, m, CASE WHEN m > 0 THEN CAST(floor({BINS} * b::DOUBLE / m::DOUBLE) AS INT) ELSE -1 END AS bin FROM f{d}),
b{d} AS (SELECT host, node, form, bin, sum(b)::DOUBLE AS b, sum(m)::DOUBLE AS m FROM e{d} WHERE bin >= 0 GROUP BY ALL),
g{d} AS (SELECT *, lag(b) OVER w AS b0, lag(m) OVER w AS m0 FROM b{d} WINDOW w AS (PARTITION BY host, node, form ORDER BY bin)),
c{d} AS (SELECT *, sum(CASE WHEN (b / m - b0 / m0) * (b / m - b0 / m0) * m * m0 > {DIFFERS * DIFFERS!r}::DOUBLE * ((b + b0) / (m + m0)) * (1 - (b + b0) / (m + m0)) * (m + m0) THEN 1 ELSE 0 END)
         OVER (PARTITION BY host, node, form ORDER BY bin) AS cluster FROM g{d}),
o{d} AS (SELECT host, node, form, bin, cluster, sum(b) OVER (PARTITION BY host, node, form, cluster) AS ob, sum(m) OVER (PARTITION BY host, node, form, cluster) AS om FROM c{d}
         UNION ALL SELECT host, node, form, -1, -1, sum(b), sum(m) FROM b{d} GROUP BY host, node, form),
l{d + 1} AS (SELECT q.host, q.shape, q.own, q.n, q.b, q.a, q.node || '/' || e.form || '#' || coalesce(o.cluster, -1) AS node, (coalesce(o.ob, 0) + {PRIOR!r}::DOUBLE * q.share) / (coalesce(o.om, 0) + {PRIOR!r}::DOUBLE) AS share
         FROM q{d} q JOIN e{d} e ON q.host = e.host AND q.node = e.node AND q.part = e.part
         LEFT JOIN o{d} o ON o.host = e.host AND o.node = e.node AND o.form = e.form AND o.bin = e.bin WHERE len(q.own) > {d}),"""


OP7_SQL = (
    r"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM h),
p AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS listed, regexp_replace(path, '[0-9]+', '0', 'g') AS shape FROM r),
t AS (SELECT host, shape, count(*) AS n, count(*) FILTER (listed = 'block') AS b, count(*) FILTER (listed = 'allow') AS a, list_filter(string_split(shape, '/'), lambda x: x <> '') AS s FROM p GROUP BY ALL),
z AS (SELECT (coalesce(sum(b), 0) + 1.0::DOUBLE) / (coalesce(sum(b + a), 0) + 2.0::DOUBLE) AS base FROM t),
l0 AS (SELECT host, shape, list_concat(s[1:5], CASE WHEN len(s) >= 6 THEN [array_to_string(s[6:], '/')] ELSE [] END, ['$']) AS own, n, b, a, '' AS node,
       (sum(b) OVER (PARTITION BY host) + 4.0::DOUBLE * base) / (sum(b + a) OVER (PARTITION BY host) + 4.0::DOUBLE) AS share FROM t, z),"""
    + "".join(_level_sql(d) for d in range(LEVELS + 1))
    + "\nx AS ("
    + " UNION ALL ".join(f"SELECT host, shape, share FROM l{d + 1} WHERE len(own) = {d + 1}" for d in range(LEVELS + 1))
    + """)
SELECT page_id, p.host AS host, path, rule, coalesce(listed, CASE WHEN share >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN x USING (host, shape)
"""
)
