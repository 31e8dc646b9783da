"""URL rules, carried over redirects and canonical links.

A rule has a host and the beginning of a path; it fits its host and all subdomains, the longest one wins. Pages
that redirect to each other or name the same canonical address are aliases: connected components over
these links. A page that no rule fits takes its aliases' decision: allowed if a rule allows any of them, else
blocked if a rule blocks any, else allowed. So explicit permission always comes first.

DataFrame functions only. Rules and aliases are equi-joined as tables of any size.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.components import components
from flowlens.llm.queries import query, table

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
CANONICAL = r"(?is)<link\b(?=[^<>]*\brel\s*=\s*[\"']?canonical)[^<>]*?\bhref\s*=\s*[\"']?([^\"'\s<>]+)"
REFRESH = r"(?is)<meta\b(?=[^<>]*\bhttp-equiv\s*=\s*[\"']?refresh)[^<>]*?\bcontent\s*=\s*[\"'][^\"'<>]*?\burl\s*=\s*([^\"'\s<>]+)"


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next slash, question mark or hash; empty if there is none."""
    return F.coalesce(lowered(F.regexp_extract(url, ADDRESS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query, which name a page whatever the scheme and fragment; null without a host."""
    host = host_of(url)
    whole = F.concat(host, F.coalesce(F.nullif(path_of(url), F.lit("")), F.lit("/")), F.regexp_extract(url, ADDRESS, 3))
    return F.when(host != "", whole)


def resolved(target: Column, url: Column) -> Column:
    """A link's target as a whole URL, seen from the page at ``url``; null without a target."""
    target = F.replace(F.nullif(target, F.lit("")), F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    near = F.concat(F.lit("x://"), host_of(url), F.coalesce(F.nullif(folder, F.lit("")), F.lit("/")), target)
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(F.lit("x://"), host_of(url), target))
        .otherwise(near)
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``source`` and ``target`` addresses of all canonical links and refreshes of pages."""
    named = F.concat(*(F.regexp_extract_all(F.col(html), F.lit(pattern), 1) for pattern in (CANONICAL, REFRESH)))
    found = pages.select(F.col(url).alias("url"), F.explode(named).alias("named")).where("named <> ''")
    return found.select(address_of(F.col("url")).alias("source"), address_of(resolved(F.col("named"), F.col("url"))).alias("target"))


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule``, ``action`` of the distinct places that a rule fits; the longest rule wins.

    Of equal rules with both actions, allow wins.
    """
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    keyed = rules.select(
        F.split_part("rule", F.lit("/"), F.lit(1)).alias("suffix"),
        F.substring("rule", F.instr("rule", "/"), F.length("rule")).alias("begin"),
        "rule",
        "action",
    ).where("instr(rule, '/') > 0")
    spread = places.where("host <> ''").distinct().select("host", "path", F.explode(suffix).alias("suffix"))
    best = F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), F.col("action") == "allow"))
    found = spread.join(keyed, "suffix").where("startswith(path, begin)").groupBy("host", "path").agg(best.alias("best"))
    return found.select("host", "path", "best.rule", "best.action")


def aliases(links: DataFrame, rules: DataFrame) -> DataFrame:
    """``address`` and ``decision`` of all addresses whose component has a rule's decision."""
    members = components(links, "source", "target").withColumnRenamed("node", "address")
    url = F.concat(F.lit("x://"), F.col("address"))
    places = members.select("address", "root", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = places.join(fitting(places.select("host", "path"), rules), ["host", "path"])
    # "allow" comes before "block"
    decided = ruled.groupBy("root").agg(F.min("action").alias("decision"))
    return members.join(decided, "root").select("address", "decision")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """A row per page: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    ``links`` (``source``, ``target`` addresses) default to those in ``pages.html``; nulls in them are ignored. A null
    URL or one without ``://`` has empty host and path, fits no rule and is allowed. Repeated rows and null
    ids are kept; an empty table gives no rows; further columns are ignored.
    """
    links = page_links(pages, url) if links is None else links
    address = F.col(url).cast("string")
    own = pages.select(
        id_col, host_of(address).alias("host"), path_of(address).alias("path"), address_of(address).alias("address")
    )
    ruled = own.join(fitting(own.select("host", "path"), rules), ["host", "path"], "left")
    found = ruled.join(aliases(links, rules), "address", "left")
    return found.select(id_col, "host", "path", "rule", F.coalesce("action", "decision", F.lit("allow")).alias("verdict"))


SQL = r"""
WITH RECURSIVE own AS (
  SELECT page_id, url, html,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3, 's'), '') AS query
  FROM pages
), rules(rule, action, rhost, rpath) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
         ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), named AS (
  SELECT host || CASE WHEN path = '' THEN '/' ELSE path END || query AS source,
         unnest(regexp_extract_all(html, '<(?:link|meta)[^<>]*(?:rel="canonical"|http-equiv="refresh")[^<>]*?(?:href="|url=)(https?://[^"'' <>]+)', 1, 'is')) AS target
  FROM own WHERE host <> ''
), places AS (
  SELECT DISTINCT source, translate(regexp_extract(target, '^.*?://([^/?#]*)', 1, 's'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || CASE WHEN regexp_extract(target, '^.*?://[^/?#]*([^?#]*)', 1, 's') = '' THEN '/' ELSE '' END
         || regexp_extract(target, '^.*?://[^/?#]*([^#]*)', 1, 's') AS target
  FROM named
), both_ways AS (
  SELECT source AS a, target AS b FROM places UNION SELECT target, source FROM places
), reach AS (
  SELECT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), nodes AS (
  SELECT DISTINCT a AS node, regexp_extract(a, '^([^/?#]*)', 1) AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM both_ways
), node_action AS (
  SELECT node, arg_max(action, length(rule)) AS action FROM nodes JOIN rules
    ON (nodes.host = rhost OR ends_with(nodes.host, '.' || rhost)) AND starts_with(nodes.path, rpath) GROUP BY node
), decided AS (
  SELECT a AS node, min(action) AS decision FROM reach JOIN node_action ON b = node GROUP BY a
), fit AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM (SELECT DISTINCT host, path FROM own) o JOIN rules
    ON (o.host = rhost OR ends_with(o.host, '.' || rhost)) AND starts_with(o.path, rpath) GROUP BY host, path
)
SELECT page_id, own.host, own.path, rule, coalesce(action, decision, 'allow') AS verdict
FROM own LEFT JOIN fit USING (host, path)
LEFT JOIN decided ON node = own.host || CASE WHEN own.path = '' THEN '/' ELSE own.path END || query
"""


@query("op5_url_filter", SQL)
def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judge(table(spark, sf, "pages"), spark.createDataFrame(RULES, "rule string, action string"))
