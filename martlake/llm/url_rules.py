"""URL filter with redirect equivalence (operator 8), DataFrame functions only.

Rules name a host and a path prefix.  A rule fits a url whose host is the
rule's or a subdomain of it and whose path starts with the rule's; the longest
fitting rule decides.  Urls without a rule take the decision of their redirect
component: the connected component over

* canonical links (``<link rel="canonical" href>``) and redirects
  (``<meta http-equiv="refresh" content="..url=">``) found in the html, relative
  ones resolved against the page's url or its ``<base href>``, and
* the usual server redirects: http to https, ``www.`` to the bare host,
  a fragment, a trailing slash, ``index.html`` and tracking parameters dropped.

A component with an explicitly allowed url is allowed (allow has precedence),
else one with a blocked url is blocked, else it is allowed.  A url with a rule
of its own always keeps that rule's action.  The rules are matched with the
targets of links too, so a target carries its decision whether it is a row or not.

Edge cases: a null url, or one without ``://``, has empty host and path and no
aliases; it fits only rules with an empty host.  Repeated rows are judged
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import stage, table
from martlake.llm.graph import components

# fixed values: action, host, path
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid)="
# a tag ends before the next one, so that a page of open tags is read once
CANONICAL = [r'(?is)<link\b[^<>]*\brel\s*=\s*["\']?canonical\b[^<>]*>', r'(?is)\bhref\s*=\s*["\']?([^"\'\s>]+)']
BASE = [r'(?is)<base\b[^<>]*>', CANONICAL[1]]
REFRESH = [r'(?is)<meta\b[^<>]*\bhttp-equiv\s*=\s*["\']?refresh\b[^<>]*>', r'(?is)\burl\s*=\s*["\']?([^"\'\s>]+)']


def lower_ascii(c) -> F.Column:
    return F.translate(c, *LOWER)


def after_scheme(url) -> F.Column:
    """What follows the first ``://``; empty for a null url or one without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url) -> F.Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url) -> F.Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical_url(url) -> F.Column:
    """The address a server redirects ``url`` to; null where there is none to compare."""
    rest = after_scheme(url)
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"(/index\.html?|/+)$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def link_in(html, patterns) -> F.Column:
    """Target of the first tag that fits ``patterns``; null where there is none."""
    href = F.regexp_extract(F.regexp_extract(html, patterns[0], 0), patterns[1], 1)
    return F.when(href != "", href)


def without_dots(path) -> F.Column:
    """``path`` with its ``.`` and ``..`` segments carried out."""
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done)
                       .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
                       .otherwise(F.concat(done, F.array(x))))
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise(""))


def resolved(target, url) -> F.Column:
    """The absolute address of ``target`` on a page at ``url``; null for other schemes (``mailto:``)
    and for a relative target where ``url`` has no scheme."""
    scheme = F.nullif(F.regexp_extract(url, r"(?is)^([a-z][a-z0-9+.-]*)://", 1), F.lit(""))
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1))
    here = path_of(url)
    query = F.regexp_extract(after_scheme(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    path, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.when(here == "", "/").otherwise(F.regexp_extract(here, r"(?s)^(.*/)", 1))
    return (F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target)
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("#"), F.concat(site, here, query, target))
            .when(target.startswith("?"), F.concat(site, here, target))
            .when(target.startswith("/"), F.concat(site, without_dots(path), rest))
            .otherwise(F.concat(site, without_dots(F.concat(folder, path)), rest)))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "action string, rule_host string, rule_path string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest fitting rule for each distinct (host, path) of ``urls``.

    Each address is spread to its host's own suffixes (``a.b.c`` to ``a.b.c``,
    ``b.c``, ``c``; no longer than the longest rule's), which join the rules by
    equality, so neither a common host nor a common suffix gathers rows in one
    task; addresses without a match are left out.
    """
    labels = F.split("host", r"\.")
    longest = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - longest + 1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
            .join(rules, "rule_host").where(F.expr("startswith(path, rule_path)")))
    best = F.max(F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"),
                          (F.col("action") == "allow").alias("a"),
                          F.concat("rule_host", "rule_path").alias("rule"), "action"))
    return (fits.groupBy("host", "path").agg(best.alias("best"))
            .select("host", "path", "best.rule", "best.action"))


def link_targets(pages: DataFrame) -> DataFrame:
    """address, target, host and path of the target: one row per distinct link of ``pages`` (url, html).

    Server redirects are the canonical address itself (:func:`canonical_url`),
    so only links in the html make edges.
    """
    link = F.explode(F.array_compact(F.array(link_in("html", CANONICAL), link_in("html", REFRESH))))
    found = (pages.select("url", link_in("html", BASE).alias("base"), link.alias("link"))
             .withColumn("base", F.coalesce(resolved(F.col("base"), F.col("url")), "url"))
             .withColumn("to", resolved(F.col("link"), F.col("base"))))
    # written here: a filter would be pushed below, with the expressions above repeated in it
    found = stage(found.select("url", "to"), "link-targets")
    return (found.select(canonical_url("url").alias("address"), canonical_url("to").alias("target"),
                         host_of(F.col("to")).alias("host"), path_of(F.col("to")).alias("path"))
            .where("address is not null and target is not null").distinct())


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, component."""
    own = pages.select(F.col(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       canonical_url(F.col("url")).alias("address"), F.lit(True).alias("is_page"))
    links = stage(link_targets(pages.select("url", "html")), "links")
    comp = components(links.select(F.col("address").alias("a"), F.col("target").alias("b")))
    # targets carry decisions as rows do
    every = own.unionByName(links.select("host", "path", F.col("target").alias("address"),
                                         F.lit(False).alias("is_page")).distinct(), allowMissingColumns=True)
    every = (every.join(comp.withColumnRenamed("node", "address"), "address", "left")
             .withColumn("component", F.coalesce("component", "address")))
    ruled = every.join(match_rules(every, rules), ["host", "path"], "left")
    ruled = stage(ruled.select(id_col, "host", "path", "component", "rule", "action", "is_page"), "ruled")
    spread = (ruled.where("component is not null and action is not null").groupBy("component")
              .agg(F.max(F.col("action") == "allow").alias("some_allow")))
    return (ruled.where("is_page").join(spread, "component", "left")
            .select(id_col, "host", "path", "rule",
                    F.coalesce("action", F.when(F.col("some_allow"), "allow"),
                               F.when(~F.col("some_allow"), "block"), F.lit("allow")).alias("verdict"),
                    "component"))


def op8_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages, rules_frame(spark))
