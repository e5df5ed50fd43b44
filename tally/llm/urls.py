"""URL rules, carried over to pages that are the same by redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.components import components

ALLOW, BLOCK = "allow", "block"

# Verdict, host, path of the default rules.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)

# Query parameters that say where a visitor came from, not which page it is.
TRACKING = "(?:utm_[a-z]+|ref)=[^&]*"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """The page behind a url: no scheme, ``www.``, fragment or tracking parameters."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(query, f"(?:^|&){TRACKING}", "")
    kept = F.regexp_replace(kept, "^&", "")
    page = F.concat(
        F.lit("://"), F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/$", "")
    )
    return F.when(kept == "", page).otherwise(F.concat(page, F.lit("?"), kept))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); allow before block on a tie."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != ALLOW, r[1], r[2]))
    cases = [
        F.when(
            ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in ordered
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*cases, none)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Redirect and canonical-link edges (url, other) between different urls.

    A url leads to the address it redirects to (``address``), and a page leads to the
    absolute target of its canonical link and of its refresh tag.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    quoted = "[\"']?([^\"'\\s>]+)"
    link = F.regexp_extract(html, r"(?i)<link\b[^>]*\brel=[\"']?canonical\b[^>]*>", 0)
    target = F.regexp_extract(link, f"(?i)href={quoted}", 1)
    meta = F.regexp_extract(html, r"(?i)<meta\b[^>]*http-equiv=[\"']?refresh\b[^>]*>", 0)
    moved = F.regexp_extract(meta, f"(?i)url={quoted}", 1)
    url = F.col(url_col)
    others = F.array(target, moved)
    leads = pages.filter(url.isNotNull()).select(
        url.alias("url"),
        F.explode(
            F.array_union(
                F.array(address(url)),
                F.flatten(
                    F.transform(
                        F.filter(others, lambda o: F.contains(o, F.lit("://"))),
                        lambda o: F.array(o, address(o)),
                    )
                ),
            )
        ).alias("other"),
    )
    ends = leads.unionByName(leads.select(F.col("other").alias("url"), address(F.col("other")).alias("other")))
    return ends.filter((F.col("url") != F.col("other")) & (F.col("other") != "://")).distinct()


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Verdict for each page: page_id, host, path, rule, verdict, component.

    The longest fitting rule decides. A page that no rule fits takes the decision of its
    aliases, the urls that redirect and canonical-link edges connect it with: allow if a rule
    allows any of them, else block if a rule blocks one, else allow. ``component`` is the
    smallest url among the aliases.

    Pages of null url, or of one without ``://``, have empty host and path, no rule, and are
    allowed. Repeated pages get one row each. Rules are compiled into the plan, so they are a
    list of hundreds, not a table. Other columns are not read.
    """
    edges = alias_edges(pages, url_col, html_col)
    found = components(edges, "url", "other")
    own = matching_rule(host(F.col("node")), path(F.col("node")), rules)["verdict"]
    decided = found.groupBy("component").agg(
        F.max((own == ALLOW).cast("int")).alias("_allow"), F.max((own == BLOCK).cast("int")).alias("_block")
    )
    inherited = found.join(decided, "component").select(
        F.col("node").alias("_node"),
        "component",
        F.when(F.col("_allow") == 1, ALLOW).when(F.col("_block") == 1, BLOCK).alias("_inherited"),
    )
    url = F.col(url_col)
    judged = pages.select(
        F.col(id_col).alias("page_id"),
        url.alias("_url"),
        F.coalesce(host(url), F.lit("")).alias("host"),
        F.coalesce(path(url), F.lit("")).alias("path"),
    ).withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    return judged.join(inherited, F.col("_url") == F.col("_node"), "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), "_inherited", F.lit(ALLOW)).alias("verdict"),
        F.coalesce("component", "_url").alias("component"),
    )
