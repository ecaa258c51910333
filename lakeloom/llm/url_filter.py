"""URL block rules that follow redirects and canonical links.

URLs that redirect to each other or name each other as canonical form one
class (a connected component). A url with a rule gets the rule's verdict. The
others get the class's: allow if some member is explicitly allowed, else block
if some member is blocked, else allow. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm._io import staged
from lakeloom.llm.components import components

_AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPACE = "[\\x20\\x09-\\x0D]"
#: a tag with its attributes; a plain class, as Java recurses on repeated groups
_TAG = "(?is)<{name}\\b([^>]*)>"
_VALUE = "(?:\"([^\"]*)\"|'([^']*)'|([^\\x20\\x09-\\x0D>\"']+))"


def _lower(c: Column) -> Column:
    return F.translate(c, *_AZ)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path by the first ``://``; both empty if there is none."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    return (_lower(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)),
            F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as written: ("block", "example.com/en/")."""
    rows = [(verdict, rule, rule.partition("/")[0], "/" + rule.partition("/")[2]) for verdict, rule in rules]
    return spark.createDataFrame(rows, "verdict string, rule string, rule_host string, rule_path string")


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); else null.

    A rule fits its host and all subdomains if the path starts with the
    rule's path. "Longest" counts the characters of host and path; of rules of
    one length that differ in verdict, allow comes first, then text order.
    The rule list is configuration and is compiled into the plan."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1]))
    out = None
    for verdict, rule in ordered:
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def node(url: Column) -> Column:
    """The name of a url in the alias graph: host and path without scheme,
    query, fragment and a slash at the end. Null if there is no host."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, "(?s)^[^#?]*\\?([^#]*)", 1)
    name = F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", name)


def _absolute(base: Column, link: Column) -> Column:
    """A link against the url of its page."""
    scheme = F.regexp_extract(base, "(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, "(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (F.when(link.rlike("(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.rlike("(?s)^[?#]|^$"), F.lit(None).cast("string"))
            .when(link.rlike("(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .otherwise(F.concat(folder, link)))


def _attribute(tag: Column, name: str) -> Column:
    pattern = f"(?is)(?:^|{_SPACE}|[\"'/]){name}{_SPACE}*={_SPACE}*{_VALUE}"
    return F.coalesce(*(F.nullif(F.regexp_extract(tag, pattern, k), F.lit("")) for k in (1, 2, 3)), F.lit(""))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, host, path): node names of every page and of its canonical
    link and the target of its meta refresh, whose host and path rules see."""
    base = pages.where(F.col(url).isNotNull() & F.col(html).isNotNull()).select(
        F.col(url).alias("url"), F.col(html).alias("html"))
    # a page without either tag ends here, before any tag is parsed
    base = base.where(F.col("html").rlike("(?i)<link\\b[^>]*canonical|<meta\\b[^>]*refresh"))
    tags = staged(base.select("url", F.explode(F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(_TAG.format(name="link")), 1),
                    lambda t: F.struct(F.lit("link").alias("kind"), t.alias("tag"))),
        F.transform(F.regexp_extract_all("html", F.lit(_TAG.format(name="meta")), 1),
                    lambda t: F.struct(F.lit("meta").alias("kind"), t.alias("tag"))))).alias("t")), "tags")
    tag = F.col("t.tag")
    canonical = _attribute(tag, "rel").rlike("(?i)(^|\\s)canonical(\\s|$)")
    refresh = _attribute(tag, "http-equiv").rlike("(?i)^\\s*refresh\\s*$")
    target = (F.when((F.col("t.kind") == "link") & canonical, _attribute(tag, "href"))
              .when((F.col("t.kind") == "meta") & refresh,
                    F.regexp_extract(_attribute(tag, "content"), "(?is)^\\s*[0-9.]*\\s*[;,]?\\s*url\\s*=\\s*[\"']?([^\"']*)", 1)))
    # Each parsing step is a written table (they are small): filters that
    # moved below would repeat all the expressions above them.
    links = staged(tags.select("url", F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))).alias("link")), "links")
    whole = staged(links.select("url", _absolute(F.col("url"), F.col("link")).alias("link")), "targets")
    host, path = url_parts(F.col("link"))
    ends = staged(whole.select(node(F.col("url")).alias("src"), node(F.col("link")).alias("dst"),
                               host.alias("host"), path.alias("path")), "url-edges")
    return ends.where(F.col("src") != F.col("dst")).distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None,
          page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, component.

    ``redirects`` (src, dst urls) adds known HTTP redirects to the links found
    in the pages. A null url, or one without ``://``, has empty host and path,
    fits no rule, belongs to no class and is allowed. ``component`` is the
    smallest node name of the class, null for a url without aliases. Repeated
    urls and ids give one row for each input row; an empty table gives an
    empty table; other columns of ``pages`` are ignored.
    """
    found = alias_edges(pages, url, html)
    edges, linked = found.select("src", "dst"), found.select(F.col("dst").alias("node"), "host", "path")
    if redirects is not None:
        moved = redirects.select(node(F.col("src")).alias("src"), node(F.col("dst")).alias("dst"),
                                 *(F.col(c).alias(f"{c}_url") for c in ("src", "dst"))).where(F.col("src") != F.col("dst"))
        edges = edges.unionByName(moved.select("src", "dst"))
        for end in ("src", "dst"):
            h, p = url_parts(F.col(f"{end}_url"))
            linked = linked.unionByName(moved.select(F.col(end).alias("node"), h.alias("host"), p.alias("path")))
    classes = components(edges)
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
                        node(F.col(url)).alias("node"))
    rows = rows.withColumn("own", matched_rule(F.col("host"), F.col("path"), rules))
    if classes is None:
        return rows.select("page_id", "host", "path", "own.rule", F.coalesce("own.verdict", F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("string").alias("component"))
    members = rows.join(classes, "node", "left")
    # A member of the class that is only linked to (no page of its own) has rules
    # as well; they see its path as linked, with a slash at the end that its node name lacks.
    linked_path = F.when(F.col("path") == "", "/").otherwise(F.col("path"))
    own = linked.withColumn("own", matched_rule(F.col("host"), linked_path, rules)).where(F.col("own").isNotNull())
    own = own.select("node", "own").distinct().join(classes, "node").select("component", "own")
    from_pages = members.where(F.col("component").isNotNull()).select("component", "own")
    decided = staged(own.unionByName(from_pages).where(F.col("own").isNotNull()).groupBy("component").agg(
        F.bool_or(F.col("own.verdict") == "allow").alias("has_allow"),
        F.bool_or(F.col("own.verdict") == "block").alias("has_block")), "url-classes")
    out = members.join(decided, "component", "left")
    method = F.when(F.col("has_block") & ~F.col("has_allow"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "own.rule", F.coalesce("own.verdict", method).alias("verdict"), "component")
