"""URL filter with redirect equivalence.

Rules decide by host suffix and path prefix. Redirects and canonical links join URLs into
components, and a decision is passed on to the aliases of a URL; an explicit allow goes before
a block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.components import connected

# (action, host, path); a rule list of this form is a parameter with tens of entries.
Rule = tuple[str, str, str]

_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct<rule, action>`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """The URL as a node of the redirect graph: a fragment never reaches the server."""
    return F.regexp_extract(url, r"(?s)^([^#]*)", 1)


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link: with its own scheme, ``//host``, ``/path`` or a relative path."""
    scheme, origin = F.regexp_extract(base, r"(?s)^(.*?):", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )


def links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Edges ``(a, b)`` from a page to its redirect targets and canonical URLs; a page may name several."""
    found = F.flatten(F.array(*[F.regexp_extract_all(F.col(html_col), F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)]))
    # Looking for both words first spares most pages the patterns.
    asks = F.lower(html_col).rlike("canonical|refresh")
    rows = pages.where(asks & F.col(url_col).contains("://")).select(F.col(url_col).alias("u"), F.explode(found).alias("l")).where("l <> ''")
    return rows.select(node_of(F.col("u")).alias("a"), node_of(resolve(F.col("u"), F.col("l"))).alias("b"))


def judge(
    pages: DataFrame,
    id_col: str,
    url_col: str,
    rules: list[Rule],
    edges: DataFrame | None = None,
    html_col: str | None = None,
    default: str = "allow",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for every row of ``pages``.

    ``edges (a, b)`` are redirects and canonical links between URLs; with ``html_col`` they are
    read from the pages. A URL that a rule fits gets that verdict. Any other takes one from the
    URLs it is linked to, whether these are pages or not: allow if a rule allows one of them,
    else block if a rule blocks one, else ``default``. A null URL, or one without ``://``, has an
    empty host and path and gets ``default``. Repeated rows and null ids are judged alike; an empty
    table gives no rows, and URLs and pages of any length are read whole. Other columns are dropped.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    rows = rows.withColumn("_hit", rule_for(F.col("host"), F.col("path"), rules))
    own = [F.col("_id").alias(id_col), "host", "path", F.col("_hit.rule").alias("rule")]
    parts = [e for e in (edges, links(pages, url_col, html_col) if html_col else None) if e is not None]
    if not parts:
        return rows.select(*own, F.coalesce("_hit.action", F.lit(default)).alias("verdict"))

    member = connected(reduce(DataFrame.unionByName, [p.select("a", "b") for p in parts]))
    hit = rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)
    decided = member.select("component", hit["action"].alias("action")).where("action is not null")
    verdicts = decided.groupBy("component").agg(F.min("action").alias("passed_on"))  # allow sorts before block
    aliases = member.join(verdicts, "component").select(F.col("node").alias("_alias"), "passed_on")

    # Only URLs without a rule look for one, and meet the shuffle; the aliases have one row per node.
    ruled = rows.where("_hit is not null").select(*own, F.col("_hit.action").alias("verdict"))
    asking = rows.where("_hit is null").withColumn("_node", node_of(F.col("_url")))
    asking = asking.join(aliases, F.coalesce("_node", F.concat(F.lit(" "), F.xxhash64("_id").cast("string"))) == aliases["_alias"], "left")
    return ruled.unionByName(asking.select(*own, F.coalesce("passed_on", F.lit(default)).alias("verdict")))
