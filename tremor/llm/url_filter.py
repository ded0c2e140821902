"""Operator 1: URL filters with redirect equivalence.

A url is judged by the longest explicit rule that fits it.  Where none
fits, its aliases decide: urls joined by redirects (a meta refresh in the
page, or rows of a crawl log's redirect table) and canonical links form
components, found by distributed connected components.  In a component an
explicit allow takes precedence; without one, an explicit block reaches all
its aliases; with neither the url is allowed.

Nodes are urls without fragment, host and scheme lower-cased.  References
are resolved against the page's url (absolute, ``//host``, ``/path``,
``?query`` and relative paths; dot segments stay as written).

Results: a null url, or one without ``://``, has empty host and path, no
rule, no alias, and is allowed.  Repeated urls share a node.  Markup inside
comments and scripts is not read.  Empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ascii_lower, cut
from tremor.llm.components import components

# The rules, as verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """From the first slash after the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule(h: Column, p: Column, rules=RULES) -> Column:
    """The longest fitting rule as (rule, verdict); null if none fits.  Equal lengths: block."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1:]))
    for verdict, rh, rp in reversed(longest_first):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        out = F.when(fits, F.struct(F.lit(rh + rp).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def node(url: Column) -> Column:
    """A url's name in the alias graph; null if it is not absolute."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    rest = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1)
    return F.when(scheme != "", F.concat(ascii_lower(scheme), F.lit("://"), host(url), rest))


def resolve(base: Column, ref: Column) -> Column:
    """A reference of a page as an absolute url; null if it is none or empty."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    folder = F.regexp_extract(base, r"^[^:]*://[^/?#]*(/(?:[^?#]*/)?)?", 1)
    ref = F.regexp_replace(F.trim(ref), "&amp;", "&")
    return (F.when((ref == "") | ref.startswith("#") | (origin == ""), None)
            .when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), ref)
            .when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(ref.startswith("//"), F.concat(scheme, ref))
            .when(ref.startswith("/"), F.concat(origin, ref))
            .when(ref.startswith("?"), F.concat(origin, path(base), ref))
            .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), ref)))


def _attribute(tag: Column, name: str) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*{q}", 1), F.lit(""))
                        for q in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'>]+)")])


def references(html: Column) -> Column:
    """Canonical links and meta refresh targets of a page, as written (array of string)."""
    read = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    links = F.filter(F.regexp_extract_all(read, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)"))
    metas = F.filter(F.regexp_extract_all(read, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    targets = F.concat(
        F.transform(links, lambda t: _attribute(t, "href")),
        F.transform(metas, lambda t: F.regexp_extract(
            F.coalesce(_attribute(t, "content"), F.lit("")),
            r"(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"']*)", 1)))
    # The cheap tests spare pages without either word the search for tags.
    may = html.rlike("(?i)canonical|http-equiv")
    return F.when(may, F.filter(targets, lambda x: x.isNotNull() & (x != "")))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(``a``, ``b``): pages and what their canonical links and refreshes name."""
    found = cut(pages.select(F.col(url).alias("u"), F.explode(references(F.col(html))).alias("ref")))
    named = cut(found.select("u", resolve(F.col("u"), F.col("ref")).alias("t")))
    return (named.select(node(F.col("u")).alias("a"), node(F.col("t")).alias("b"))
            .where("a is not null and b is not null and a <> b").distinct())


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, key: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``reason`` (rule, alias or default)
    of every page; ``redirects`` may add pairs (``source``, ``target``) of urls."""
    edges = alias_edges(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(node(F.col("source")), node(F.col("target"))))
    edges = cut(edges)
    named = components(edges, "a", "b")
    # Decisions of all urls in the graph, the pages' and those only referred to.
    member = edges.select(F.col("a").alias("n")).union(edges.select("b")).distinct()
    member = member.join(named, F.col("n") == F.col("node"), "left").select(
        "n", F.coalesce("component", "n").alias("component"))
    own = rule(host(F.col("n")), path(F.col("n")), rules)["verdict"]
    decided = (member.groupBy("component").agg(
        F.max((own == "allow").cast("int")).alias("allows"),
        F.max((own == "block").cast("int")).alias("blocks"))
        .where("allows = 1 or blocks = 1")
        .select("component", F.when(F.col("allows") == 1, "allow").otherwise("block")
                .alias("by_alias")))
    aliases = cut(member.join(decided, "component").select(F.col("n").alias("_node"), "by_alias"))
    judged = pages.select(F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
                          node(F.col(url)).alias("_n"))
    judged = judged.withColumn("_r", rule(F.col("host"), F.col("path"), rules))
    joined = judged.join(aliases, F.col("_n") == F.col("_node"), "left")
    return joined.select(
        key, "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce("_r.verdict", "by_alias", F.lit("allow")).alias("verdict"),
        F.when(F.col("_r").isNotNull(), "rule").when(F.col("by_alias").isNotNull(), "alias")
        .otherwise("default").alias("reason"))
