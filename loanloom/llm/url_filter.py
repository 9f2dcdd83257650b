"""URL filter with redirect equivalence, in DataFrame operations only.

A rule (host, path, verdict) fits a url whose host is the rule's or lies below it and whose
path starts with the rule's; the longest rule wins.  Pages that redirect to
each other or name each other canonical are aliases: connected components of
those links.  A block passes on to all aliases that no rule of their own decides, so an
explicit allow always stands.  What no rule and no blocked alias decides is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.components import connected_components
from loanloom.llm.frames import quoted, stored

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not name another page.
TRACKING = r"(^|&)(utm_[^=&]*|gclid|fbclid)=[^&]*"
#: What is no tag though it may look like one; the tags that name another url; where they name it.
NOISE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL, HREF = r"""(?is)\brel\s*=\s*["']?canonical\b""", r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH, REFRESH_URL = r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b""", r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a url.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    goes on up to ``?``, ``#`` or the end.  All are empty for a null url or one without ``://``.
    """
    start = F.instr(url, "://")
    rest = F.coalesce(F.when(start > 0, F.substr(url, start + 3)), F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1))


def normal_form(url: Column) -> Column:
    """One name for the spellings of a url: no scheme, fragment, closing slashes or tracking parameters; empty without ``://``."""
    host, path, query = url_parts(url)
    kept = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    return F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def resolved(target: Column, url: Column) -> Column:
    """A link target as a whole url, read from the page it stands on."""
    host, path, _ = url_parts(url)
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    base = F.concat(scheme, F.lit("://"), host)
    return (F.when(target.contains("://"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(base, target))
            .otherwise(F.concat(base, F.coalesce(F.nullif(F.regexp_extract(path, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/")), target)))


def page_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(u, v): normal forms tied by a canonical link or a meta refresh, as the pages state them."""
    rows = pages.select(quoted(url_column).alias("url"), quoted(html_column).alias("html")).where(
        (F.instr("url", "://") > 0) & F.col("html").rlike(r"(?i)canonical|refresh"))
    tags = F.regexp_extract_all(F.regexp_replace("html", NOISE, " "), F.lit(TAGS), F.lit(0))
    tag = rows.select("url", F.explode(tags).alias("tag"))
    to = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", REFRESH_URL, 1))
    ends = tag.select("url", F.replace(to, F.lit("&amp;"), F.lit("&")).alias("to")).where("to <> ''")
    # Written in between: nested, the expressions would outgrow generated code.
    ends = stored(ends.select("url", resolved(F.col("to"), F.col("url")).alias("whole")), "url-links")
    return ends.select(normal_form(F.col("url")).alias("u"), normal_form(F.col("whole")).alias("v"))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule that fits, or null.

    Of rules equally long the first by name wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_column: str = "page_id", url_column: str = "url",
          html_column: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """One row for each page row: page_id, host, path, rule, verdict, and by what it was decided.

    ``rules`` holds (host, path, allow or block); ``redirects`` may add (from_url, to_url) links seen
    by a crawler.  A null url, or one without ``://``, has empty host and path, no alias, and is allowed.
    Repeated rows are judged alike.
    """
    host, path, _ = url_parts(F.col("url"))
    rows = pages.select(quoted(id_column).alias("page_id"), quoted(url_column).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"), F.nullif(normal_form(F.col("url")), F.lit("")).alias("node"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "own": verdict})
    links = page_links(pages, url_column, html_column)
    if redirects is not None:
        links = links.union(redirects.select(normal_form(F.col("from_url")), normal_form(F.col("to_url"))))
    # Spellings of one url are one node already; only links between nodes need components.
    component = stored(connected_components(links.where("u <> '' and v <> ''")), "url-components")
    blocked = rows.where(F.col("own") == BLOCK).select("node").distinct()
    spread = (component.join(blocked, "node", "left_semi").select("component").distinct()
              .join(component, "component").select("node"))
    condemned = stored(blocked.union(spread).distinct().withColumn("condemned", F.lit(True)), "url-blocked")
    # A page that needs no look-up gets a key of its own, which no node has, so that such rows spread evenly.
    free = rows.withColumn("asked", F.when(F.col("own").isNull() & F.col("node").isNotNull(), F.col("node"))
                           .otherwise(F.concat(F.lit(" "), F.xxhash64("page_id", "path").cast("string"))))
    met = free.join(condemned.hint("merge"), free["asked"] == condemned["node"], "left")
    return met.select("page_id", "host", "path", "rule",
                      F.coalesce("own", F.when(F.col("condemned"), F.lit(BLOCK)), F.lit(ALLOW)).alias("verdict"),
                      F.when(F.col("own").isNotNull(), "rule").when(F.col("condemned"), "alias").otherwise("none").alias("decided_by"))
