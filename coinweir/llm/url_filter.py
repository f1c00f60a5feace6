"""URL verdicts that follow redirects and canonical links.

Rules allow or block a host with its subdomains below a path; of several that fit, the longest counts. Urls that redirect to each
other, or name one another as canonical, are one page under several names: the connected components of those edges. A blocked name blocks
those names of its component that no rule judges, unless a rule allows one of its names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.llm.components import components
from coinweir.llm.tables import stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SCHEME = r"(?s)^(.*?)://"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
# A tag ends at the next `<` at the latest, so that broken pages take no longer to search.
CANONICAL_TAG = r"""(?is)<link\s(?:[^<>]*\s)?rel\s*=\s*(?:"(?:[^"<>]*\s)?|'(?:[^'<>]*\s)?|)canonical(?:["'\s/][^<>]*)?>"""
REFRESH_TAG = r"""(?is)<meta\s(?:[^<>]*\s)?http-equiv\s*=\s*["']?\s*refresh(?:["'\s/][^<>]*)?>"""
HREF = r"""(?is)\shref\s*=\s*("[^"<>]*"|'[^'<>]*'|[^"'<>\s]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'<>\s]+)"""
AROUND = r"""^["'\s]+|["'\s]+$"""
DOTS = r"/\.{1,2}(/|$)"
# Character references that urls are written with. `&` comes last, so that nothing is read twice.
REFERENCES = [("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#x26;", "&"), ("&#38;", "&"), ("&amp;", "&")]
FRAGMENT = r"(?s)#.*$"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands behind the first `://`, up to `/`, `?`, `#` or the end, with A-Z in lower case; empty without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null. The rules become one expression."""
    if any(rule.verdict not in (ALLOW, BLOCK) for rule in rules):
        raise ValueError("a rule allows or blocks")

    def chosen(give: str) -> Column:
        found = F.lit(None).cast("string")
        for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
            fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
            found = F.when(fits, F.lit(getattr(rule, give))).otherwise(found)
        return found

    return chosen("name"), chosen("verdict")


def node_of(url: Column) -> Column:
    """The name under which a url takes part: without its fragment, its host in lower case; null without `://`."""
    plain = F.regexp_replace(url, FRAGMENT, "")
    head = F.regexp_extract(plain, r"(?s)^(.*?://)", 1)
    named = F.concat(head, host_of(plain), F.regexp_replace(plain, HOST, ""))
    return F.when(F.contains(url, F.lit("://")), named)


def without_dots(path: Column) -> Column:
    """A path after its segments `.` and `..` have taken effect."""
    closed = F.when(path.rlike(r"/\.{1,2}$"), F.concat(path, F.lit("/"))).otherwise(path)

    def step(walked: Column, part: Column) -> Column:
        up = F.regexp_replace(walked, "/[^/]*$", "")
        return F.when(part == ".", walked).when(part == "..", up).otherwise(F.concat(walked, F.lit("/"), part))

    walked = F.aggregate(F.split(F.substr(closed, F.lit(2)), "/"), F.lit(""), step)
    return F.when(path.rlike(DOTS), walked).otherwise(path)


def absolute(target: Column, url: Column) -> Column:
    """A link's target as it stands in a page, made absolute by the page's url."""
    head = F.concat(F.regexp_extract(url, SCHEME, 1), F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    own, query = F.regexp_extract(target, r"(?s)^[^?#]*", 0), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(url, SCHEME, 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(head, without_dots(own), query))
        .when(target.startswith("?"), F.concat(head, path_of(url), target))
        .otherwise(F.concat(head, without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), own)), query))
    )


def links_of(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """(src, dst) of all canonical links and refresh redirects of the pages. `canonical` may be one of several words of a link's rel. Character
    references of urls are read, and targets without a host are taken from the page's own url; a `base` tag isn't looked at."""
    url, html = F.col("url"), F.col("html")
    rows = pages.select(F.col(url_column).alias("url"), F.col(html_column).alias("html"))

    def targets(tag: str, at: str) -> Column:
        return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda each: F.regexp_extract(each, at, 1))

    found = F.concat(targets(CANONICAL_TAG, HREF), targets(REFRESH_TAG, REFRESH_URL))
    rows = rows.select("url", F.explode(F.array_distinct(found)).alias("target"))
    target = F.regexp_replace("target", AROUND, "")
    for written, meant in REFERENCES:
        target = F.replace(target, F.lit(written), F.lit(meant))
    rows = rows.select("url", target.alias("target")).filter("target <> '' AND NOT startswith(target, '#')")
    links = rows.select(node_of(url).alias("src"), node_of(absolute(F.col("target"), url)).alias("dst"))
    return links.filter("src IS NOT NULL AND dst IS NOT NULL")


def blocked_aliases(edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """(node) of every component that a rule blocks somewhere and none allows anywhere."""
    grouped = components(edges)
    _, verdict = rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)
    judged = stored(grouped.select("node", "component", verdict.alias("verdict")))
    blocked = judged.groupBy("component").agg(
        F.bool_or(F.col("verdict") == BLOCK).alias("blocked"), F.bool_or(F.col("verdict") == ALLOW).alias("allowed")
    )
    blocked = blocked.filter(F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False)))
    return judged.join(blocked, "component", "left_semi").select("node")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page.

    `redirects` (src, dst: urls) are edges known from elsewhere, beside those in the pages. A url without a rule is allowed unless
    an alias is blocked. Null urls and urls without `://` have an empty host and path, fit no rule but one for the empty host, and
    have no aliases; null pages have no links; repeated rows are judged alike, once each.
    """
    edges = links_of(pages, url_column, html_column)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst")))
    aliases = blocked_aliases(edges, rules)
    url = F.col(url_column)
    rows = pages.select(F.col(id_column).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled"))
    rows = rows.join(aliases.withColumn("alias", F.lit(BLOCK)), "node", "left")
    return rows.select(
        F.col("_id").alias(id_column), "host", "path", "rule", F.coalesce("ruled", "alias", F.lit(ALLOW)).alias("verdict")
    )


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(rules: list[Rule]) -> str:
    """`judge` over `pages` as DuckDB SQL."""
    host = f"translate(regexp_extract(coalesce({{0}}, ''), {_sql(HOST)}, 1), '{UPPER}', '{LOWER}')"
    path = f"regexp_extract(coalesce({{0}}, ''), {_sql(PATH)}, 1)"

    def chosen(give: str) -> str:
        ordered = sorted(rules, key=lambda rule: (len(rule.name), rule.name), reverse=True)
        fits = [
            f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}') THEN '{getattr(rule, give)}'"
            for rule in ordered
        ]
        return f"CASE {' '.join(fits)} END"

    def node(url: str) -> str:
        plain = f"regexp_replace({url}, {_sql(FRAGMENT)}, '')"
        head = f"regexp_extract({plain}, '(?s)^(.*?://)', 1)"
        return f"CASE WHEN contains({url}, '://') THEN {head} || {host.format(plain)} || regexp_replace({plain}, {_sql(HOST)}, '') END"

    def target(tag: str, at: str) -> str:
        return f"SELECT url, regexp_extract(unnest(regexp_extract_all(html, {_sql(tag)}, 0)), {_sql(at)}, 1) AS target FROM pages"

    def dotless(text: str) -> str:
        closed = f"CASE WHEN regexp_matches({text}, '/\\.{{1,2}}$') THEN ({text}) || '/' ELSE {text} END"
        step = "CASE part WHEN '.' THEN walked WHEN '..' THEN regexp_replace(walked, '/[^/]*$', '') ELSE walked || '/' || part END"
        walked = f"list_reduce(string_split(substr({closed}, 2), '/'), lambda walked, part: {step}, '')"
        return f"CASE WHEN regexp_matches({text}, {_sql(DOTS)}) THEN {walked} ELSE {text} END"

    scheme = f"regexp_extract(url, {_sql(SCHEME)}, 1)"
    head = f"{scheme} || '://' || {host.format('url')}"
    page, own, query = path.format("url"), "regexp_extract(target, '(?s)^[^?#]*', 0)", "regexp_extract(target, '(?s)^[^?#]*(.*)$', 1)"
    folder = f"regexp_replace({page}, '[^/]*$', '')"
    below = f"(CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || {own})"
    read = f"regexp_replace(target, {_sql(AROUND)}, '', 'g')"
    for written, meant in REFERENCES:
        read = f"replace({read}, {_sql(written)}, {_sql(meant)})"
    absolute = (
        f"CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN target "
        f"WHEN starts_with(target, '//') THEN {scheme} || ':' || target "
        f"WHEN starts_with(target, '/') THEN {head} || ({dotless(own)}) || {query} "
        f"WHEN starts_with(target, '?') THEN {head} || {page} || target "
        f"ELSE {head} || ({dotless(below)}) || {query} END"
    )
    return f"""WITH RECURSIVE targets AS ({target(CANONICAL_TAG, HREF)} UNION ALL {target(REFRESH_TAG, REFRESH_URL)}),
meant AS (SELECT url, {read} AS target FROM targets),
absolute AS (SELECT url, {absolute} AS target FROM meant WHERE target <> '' AND NOT starts_with(target, '#')),
links AS (SELECT {node("url")} AS src, {node("target")} AS dst FROM absolute),
edges AS (SELECT src, dst FROM links WHERE src <> dst UNION SELECT dst, src FROM links WHERE src <> dst),
reach AS (SELECT src, dst FROM edges UNION SELECT reach.src, edges.dst FROM reach JOIN edges ON reach.dst = edges.src),
parts AS (SELECT src, dst, {host.format("dst")} AS host, {path.format("dst")} AS path FROM reach),
aliases AS (SELECT src AS node FROM (SELECT src, {chosen("verdict")} AS verdict FROM parts) GROUP BY src
  HAVING bool_or(verdict = '{BLOCK}') AND NOT coalesce(bool_or(verdict = '{ALLOW}'), false)),
parsed AS (SELECT page_id, {host.format("url")} AS host, {path.format("url")} AS path, {node("url")} AS node FROM pages)
SELECT page_id, host, path, {chosen("name")} AS rule,
  coalesce({chosen("verdict")}, CASE WHEN aliases.node IS NOT NULL THEN '{BLOCK}' END, '{ALLOW}') AS verdict
FROM parsed LEFT JOIN aliases ON parsed.node = aliases.node"""
