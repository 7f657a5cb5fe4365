"""URL filter: explicit rules, then a path-template tree per host. DataFrame functions only.

1. A url is split into host and path, and the longest fitting rule decides it. The
   urls that rules decided are the labelled ones the tree learns from
   (other labels may be given instead).
2. *Tree.* Level by level from the host down, a segment that is rare among those below the same
   node is variable and becomes a wildcard, shown as ``*`` (its file extension stays); frequent ones stay
   literal. A node is its parent's template and a segment, so ``/news/*/comments`` is counted over all articles.
   Below a node of fewer than ``SUPPORT`` urls nothing is frequent, so the levels end there.
3. *Merging*, from the deepest level up. The children of a node that lead to the same page shape (the
   rest of the template that most of their urls have) are ordered by their
   share of blocked labels. Neighbours whose shares do not differ (two-proportion z) are
   one branch, shown as ``a|b``; branches without labels are one branch as well.
4. *Purity.* A template's share of blocked labels is smoothed towards its host's share, and
   that towards the share over all hosts. Templates that reach ``REJECT`` are blocked.

Everything is counted by partial aggregation before it is shuffled. A level is one written
table of the urls that reach it, so the number of jobs follows the depth at which ``SUPPORT`` urls still share a node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, materialize

# no path holds these two: a wildcard, and between the names of merged branches; shown as * and |
WILD, BESIDE = "?", "#"
SUPPORT = 3         # a literal segment occurs at least so often ...
SHARE = 0.01        # ... and in at least this share of the urls below its parent
Z = 2.58            # a difference of label shares counts from here on
SMOOTH = 20.0       # weight of the level above, in urls
REJECT = 0.8


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host behind the first ``://`` up to ``/?#``, A-Z lower-cased; path
    behind it up to ``?#``. Both empty for null and for a url without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return (F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit("")))


def rule_column(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest fitting rule (host, path, verdict), else null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def _extension(segment: Column) -> Column:
    return F.regexp_extract(segment, r"\.[A-Za-z]{1,5}$", 0)


def _ratio(a, b) -> Column:
    return a / F.nullif(b, F.lit(0))


def _wildcard(segment: Column) -> Column:
    return F.when(segment == "", segment).otherwise(F.concat(F.lit(WILD), _extension(segment)))


def _templates(urls: DataFrame) -> tuple[DataFrame, int]:
    """Distinct urls (host, path, ...) with ``node``, their template, and the last level that
    has a node of ``SUPPORT`` urls."""
    segments = F.split("path", "/")  # the first one is empty: a path is empty or begins with /
    left = urls.withColumn("node", F.lit("")).withColumn("depth", F.size(segments) - 1)
    ended, level = [left.where("depth = 0")], 0
    while True:
        left = left.where(F.col("depth") > level).withColumn("segment", F.get(segments, F.lit(level + 1)))
        opened, nodes = materialize(left.groupBy("host", "node").agg(F.count(F.lit(1)).alias("total"))
                                    .where(F.col("total") >= SUPPORT), "url_nodes", count=True)
        if not nodes:
            break
        # segments that occur once or twice go before the join, so a hot node has few rows in it
        literal = (left.groupBy("host", "node", "segment").agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") >= SUPPORT).join(opened, ["host", "node"])
                   .where(F.col("n") >= F.lit(SHARE) * F.col("total"))
                   .select("host", "node", "segment", F.lit(True).alias("literal")))
        part = F.when(F.col("literal"), F.col("segment")).otherwise(_wildcard(F.col("segment")))
        level += 1
        left = materialize(left.join(literal, ["host", "node", "segment"], "left")
                           .withColumn("node", F.concat("node", F.lit("/"), part))
                           .select(*urls.columns, "node", "depth"), "url_level")
        ended.append(left.where(F.col("depth") == level))
    rest = F.transform(F.slice(segments, level + 2, F.size(segments)), lambda s: F.concat(F.lit("/"), _wildcard(s)))
    out = left.withColumn("node", F.concat("node", F.array_join(rest, "")))
    for e in ended:
        out = out.unionByName(e, allowMissingColumns=True)
    return out.select(*urls.columns, "node"), level


def _merged(leaf: DataFrame, level: int) -> DataFrame:
    """Templates with ``branch``, the same with similar siblings at ``level`` under one name. A node
    has at most 1 / SHARE literal children and their wildcards, so the windows are small."""
    old, now = F.split("node", "/"), F.split("branch", "/")
    part = lambda xs, first, n: F.array_join(F.slice(xs, first, n), "/")
    size = F.size(old)
    leaf = (leaf.withColumn("parent", part(old, 1, level)).withColumn("child", F.get(old, F.lit(level)))
            .withColumn("tail", part(now, level + 2, size)))
    shape = (leaf.where("child IS NOT NULL").groupBy("host", "parent", "child", "tail").agg(
        *(F.sum(c).alias(c) for c in ("urls", "n", "marked", "blocked"))))
    child = shape.groupBy("host", "parent", "child").agg(
        F.sum("urls").alias("urls"), F.sum("marked").alias("marked"), F.sum("blocked").alias("blocked"),
        F.max(F.struct("n", "tail")).getField("tail").alias("shape"))
    child = child.withColumn("share", _ratio(F.col("blocked"), F.col("marked")))
    child = child.withColumn("total", F.sum("urls").over(Window.partitionBy("host", "parent"))).where(
        F.col("total") >= SUPPORT)
    row = Window.partitionBy("host", "parent", "shape", F.col("share").isNull()).orderBy("share", "child")
    m, b = F.col("marked"), F.col("blocked")
    lm, lb = F.lag("marked").over(row), F.lag("blocked").over(row)
    pool = _ratio(lb + b, lm + m)
    spread = F.sqrt(pool * (1 - pool) * (_ratio(F.lit(1), m) + _ratio(F.lit(1), lm)))
    z = _ratio(F.abs(_ratio(b, m) - _ratio(lb, lm)), spread)
    child = child.withColumn("new", F.coalesce((z >= Z).cast("int"), F.lit(0)))
    child = child.withColumn("island", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("host", "parent", "shape", F.col("share").isNull(), "island")
    name = F.array_join(F.array_sort(F.collect_list("child").over(whole)), BESIDE)
    names = child.select("host", "parent", "child", name.alias("name"))
    renamed = F.concat_ws("/", F.slice(now, 1, level), F.array("name"), F.slice(now, level + 2, size))
    return (leaf.join(names, ["host", "parent", "child"], "left")
            .withColumn("branch", F.when(F.col("name").isNull(), F.col("branch")).otherwise(renamed))
            .drop("parent", "child", "tail", "name"))


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], *, id_col: str = "page_id",
               url_col: str = "url", bad_col: str | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, purity.

    ``rules`` are (host, path, "allow" or "block"); a rule fits its host and all
    subdomains if the path starts with its path, the longest wins. verdict is the rule's,
    else the template tree's. The tree learns from the rules' own verdicts, or from the
    boolean ``bad_col`` (null: unlabelled). A null url, or one without ``://``, has empty host
    and path. Null and repeated ids and urls are kept row by row, paths of any length are
    read whole, other columns are left out, an empty table gives no rows; with no
    label at all nothing is blocked.
    """
    bad = F.lit(None).cast("boolean") if bad_col is None else F.col(f"`{bad_col}`").cast("boolean")
    host, path = url_parts(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"), bad.alias("bad"))
    urls = urls.withColumn("hit", rule_column(rules, F.col("host"), F.col("path")))
    if bad_col is None:
        urls = urls.withColumn("bad", F.col("hit.verdict") == "block")
    # equal urls share one template, so the tree is built on distinct (host, path)
    distinct = materialize(urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("marked"),
        F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("blocked")), "urls")
    named, levels = _templates(distinct)
    leaf = materialize(named.groupBy("host", "node").agg(
        F.count(F.lit(1)).alias("urls"), F.sum("n").alias("n"), F.sum("marked").alias("marked"),
        F.sum("blocked").alias("blocked")).withColumn("branch", F.col("node")), "url_templates")
    for level in range(levels, 0, -1):
        leaf = materialize(_merged(leaf, level), "url_branches")
    tree = leaf.groupBy("host", "branch").agg(F.sum("marked").alias("marked"), F.sum("blocked").alias("blocked"))
    hosts = leaf.groupBy("host").agg(F.sum("marked").alias("hm"), F.sum("blocked").alias("hb"))
    world = leaf.agg(F.coalesce(_ratio(F.sum("blocked"), F.sum("marked")), F.lit(0.0))).scalar()
    purity = (tree.join(hosts, "host")
              .withColumn("own", (F.col("hb") + SMOOTH * world) / (F.col("hm") + SMOOTH))
              .select("host", "branch",
                      ((F.col("blocked") + SMOOTH * F.col("own")) / (F.col("marked") + SMOOTH))
                      .alias("purity")))
    judged = leaf.select("host", "node", "branch").join(purity, ["host", "branch"]).select(
        "host", "node", "purity", F.translate("branch", WILD + BESIDE, "*|").alias("template"))
    by_url = named.select("host", "path", "node").join(judged, ["host", "node"])
    return (urls.join(by_url.select("host", "path", "template", "purity"), ["host", "path"])
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.verdict", F.when(F.col("purity") >= REJECT, "block")
                               .otherwise("allow")).alias("verdict"), "template", "purity"))


def oracle(rules: list[tuple[str, str, str]], source: str = "pages") -> str:
    """The same, learning from the rules, as DuckDB SQL."""
    table = " UNION ALL ".join(f"SELECT '{h}' AS h, '{p}' AS p, '{v}' AS v" for h, p, v in rules)
    return rf"""
WITH RECURSIVE rules AS ({table}),
raw AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM {source}),
parts AS (
  SELECT rid, page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS h0, coalesce(rest, '') AS rest
  FROM raw),
urls0 AS (
  SELECT rid, page_id, translate(h0, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path
  FROM parts),
fit AS (
  SELECT rid, max_by(struct_pack(rule := h || p, verdict := v), length(h || p)) AS hit
  FROM urls0 JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY rid),
urls AS MATERIALIZED (
  SELECT u.*, f.hit.rule AS rule, f.hit.verdict AS rv FROM urls0 u LEFT JOIN fit f USING (rid)),
dist AS MATERIALIZED (
  SELECT host, path, count(*) AS n, count(rv) AS marked, count(*) FILTER (rv = 'block') AS blocked
  FROM urls GROUP BY host, path),
named AS (
  SELECT host, path, n, marked, blocked, string_split(path, '/')[2:] AS s, 0 AS d, '' AS node FROM dist
  UNION ALL
  SELECT host, path, n, marked, blocked, s, d + 1, node || '/' || CASE
      WHEN g = '' OR (same >= {SUPPORT} AND same >= {SHARE} * total) THEN g
      ELSE '{WILD}' || regexp_extract(g, '\.[A-Za-z]{{1,5}}$') END
  FROM (SELECT *, list_extract(s, d + 1) AS g, count(*) OVER (PARTITION BY host, node) AS total,
               count(*) OVER (PARTITION BY host, node, list_extract(s, d + 1)) AS same
        FROM named WHERE d < len(s))),
leaf AS MATERIALIZED (
  SELECT host, node, count(*) AS urls, CAST(sum(n) AS BIGINT) AS n, CAST(sum(marked) AS BIGINT) AS m,
         CAST(sum(blocked) AS BIGINT) AS b, string_split(node, '/')[2:] AS p
  FROM named WHERE d = len(s) GROUP BY host, node),
tree AS (
  SELECT *, (SELECT coalesce(max(len(p)), 0) FROM leaf) AS d, p AS cur FROM leaf
  UNION ALL
  SELECT host, node, urls, n, m, b, p, d - 1, CASE WHEN len(p) < d OR total < {SUPPORT} THEN cur
      ELSE cur[:d - 1] || [array_to_string(list_sort(list_distinct(list(g) OVER (
          PARTITION BY host, up, len(p) < d, total < {SUPPORT}, shape, share IS NULL, island))), '{BESIDE}')] || cur[d + 1:] END
  FROM (
    SELECT *, sum(CASE WHEN lg <> g AND z >= {Z} THEN 1 ELSE 0 END) OVER (
        PARTITION BY host, up, len(p) < d, shape, share IS NULL ORDER BY share, g, node ROWS UNBOUNDED PRECEDING) AS island
    FROM (
      SELECT *, abs(gb / nullif(gm, 0) - lb / nullif(lm, 0)) / nullif(sqrt(
          (lb + gb) / nullif(lm + gm, 0) * (1 - (lb + gb) / nullif(lm + gm, 0))
          * (1 / nullif(gm, 0) + 1 / nullif(lm, 0))), 0) AS z
      FROM (
        SELECT *, lag(g) OVER w AS lg, lag(gm) OVER w AS lm, lag(gb) OVER w AS lb
        FROM (
          SELECT *, gb / nullif(gm, 0) AS share,
                 max(struct_pack(x := tn, t := tail)) OVER (PARTITION BY host, up, g, len(p) < d).t AS shape
          FROM (
            SELECT *, sum(n) OVER (PARTITION BY host, up, g, tail, len(p) < d) AS tn,
                   sum(m) OVER (PARTITION BY host, up, g, len(p) < d) AS gm,
                   sum(b) OVER (PARTITION BY host, up, g, len(p) < d) AS gb,
                   sum(urls) OVER (PARTITION BY host, up, len(p) < d) AS total
            FROM (SELECT *, array_to_string(p[:d - 1], '/') AS up, list_extract(p, d) AS g,
                         array_to_string(cur[d + 1:], '/') AS tail FROM tree WHERE d > 0)))
        WINDOW w AS (PARTITION BY host, up, len(p) < d, shape, share IS NULL ORDER BY share, g, node))))),
ho AS (SELECT host, sum(m) AS hm, sum(b) AS hb FROM leaf GROUP BY ALL),
world AS (SELECT coalesce(sum(b) / nullif(sum(m), 0), 0) AS share FROM leaf),
pure AS (
  SELECT host, cur, (sum(b) + {SMOOTH} * (any_value(hb) + {SMOOTH} * any_value(share)) / (any_value(hm) + {SMOOTH}))
      / (sum(m) + {SMOOTH}) AS purity
  FROM tree JOIN ho USING (host), world WHERE d = 0 GROUP BY host, cur)
SELECT u.page_id, u.host, u.path, u.rule,
       coalesce(u.rv, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN len(cur) = 0 THEN '' ELSE '/' || translate(array_to_string(cur, '/'), '{WILD}{BESIDE}', '*|') END AS template
FROM urls u JOIN (SELECT host, path, node FROM named WHERE d = len(s)) USING (host, path)
JOIN (SELECT host, node, cur FROM tree WHERE d = 0) USING (host, node) JOIN pure USING (host, cur)"""
