"""User agent -> browser name/version, OS name/version (P5).

The parsing library of the source system is not available, so the rules are
ours: an ordered list of (test pattern, name, version pattern) evaluated as
one native CASE expression, first match wins.  Unknown agents give the name
``Unknown`` and a NULL version.  Versions are the full dotted token; '_' in OS
versions is printed as '.'.

An agent comes from outside and may be of any length, so every pattern runs in
time proportional to it and without recursion: no repeated groups that can backtrack
(Java's matcher calls itself once per repetition), and no ``.*`` after a token
that may occur many times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# A crawler's token ends in '/', ';', ')' or the text (a phone model with "bot" in its name does not);
# words before it belong to its name.
CRAWLER = r"(?i)(?:bot|spider|crawler)(?:[/;)]|\z)"
UPTO_CRAWLER = r"(?is)^(.*?(?:bot|spider|crawler))(?=[/;)]|\z)"
# read backwards from the token, possessive: nothing is tried twice
NAME_BACKWARDS = r"(?i)^[a-z0-9_-]*+(?: [a-z]++)*+"

# Browser rules in priority order.  ``name`` None means that the agent names itself.
# (first token as a pattern, literal that must come later or None, name, version pattern)
BROWSER_RULES = [
    (CRAWLER, None, None, r"^/?([0-9.]*+)"),
    (r"Edg(e|A|iOS)?/", None, "Edge", r"Edg(?:e|A|iOS)?/([0-9.]+)"),
    (r"OPR/", None, "Opera", r"OPR/([0-9.]+)"),
    (r"CriOS/", None, "Chrome", r"CriOS/([0-9.]+)"),
    (r"Chrome/", None, "Chrome", r"Chrome/([0-9.]+)"),
    (r"Firefox/", None, "Firefox", r"Firefox/([0-9.]+)"),
    (r"Version/[0-9.]", "Safari/", "Safari", r"Version/([0-9.]+)"),
    (r"MSIE ", None, "IE", r"MSIE ([0-9.]+)"),
    (r"Trident/", "rv:", "IE", r"rv:([0-9.]+)"),
]

# OS rules in priority order, in the same form.
OS_RULES = [
    (r"Windows NT ", None, "Windows", r"Windows NT ([0-9.]+)"),
    (r"iPhone OS |iPad; CPU OS ", None, "iOS", r"OS ([0-9_]+)"),
    (r"Android", None, "Android", r"Android ([0-9.]+)"),
    (r"Mac OS X", None, "Mac OS X", r"Mac OS X ([0-9_.]+)"),
    (r"Linux", None, "Linux", None),
]


def _version(ua: Column, pattern: str, group: int = 1) -> Column:
    v = F.regexp_extract(ua, pattern, group)
    return F.nullif(F.regexp_replace(v, "_", "."), F.lit(""))


def _matches(ua: Column, token: str, later: str | None) -> Column:
    """The token occurs, and ``later`` after its first occurrence (after any other it is after the first)."""
    if later is None:
        return ua.rlike(token)
    at = F.regexp_instr(ua, F.lit(token))
    return (at > 0) & (F.locate(later, F.substring(ua, at, F.length(ua))) > 0)


def _crawler_text(ua: Column) -> Column:
    """The agent up to the end of its crawler token."""
    return F.regexp_extract(ua, UPTO_CRAWLER, 1)


def _crawler_name(ua: Column) -> Column:
    name = F.reverse(F.regexp_extract(F.reverse(_crawler_text(ua)), NAME_BACKWARDS, 0))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN))


def _rule_index(ua: Column, rules) -> Column:
    """Index of the first rule that matches, NULL if none.

    Evaluated once per row; name and version then branch on a small int, so
    each row runs the test patterns only until the first hit.
    """
    expr = None
    for i, (token, later, *_rest) in enumerate(rules):
        test = _matches(ua, token, later)
        expr = F.when(test, F.lit(i)) if expr is None else expr.when(test, F.lit(i))
    return expr


def _by_index(idx: Column, values: list[Column], default: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr.otherwise(default)


def browser_name(ua: Column, idx: Column | None = None) -> Column:
    idx = _rule_index(ua, BROWSER_RULES) if idx is None else idx
    names = [F.lit(name) if name is not None else _crawler_name(ua) for _, _, name, _ in BROWSER_RULES]
    return _by_index(idx, names, F.lit(UNKNOWN))


def browser_version(ua: Column, idx: Column | None = None) -> Column:
    idx = _rule_index(ua, BROWSER_RULES) if idx is None else idx
    after_name = F.substring(ua, F.length(_crawler_text(ua)) + 1, F.length(ua))
    versions = [_version(ua if name is not None else after_name, vpat) for _, _, name, vpat in BROWSER_RULES]
    return _by_index(idx, versions, F.lit(None).cast("string"))


def os_name(ua: Column, idx: Column | None = None) -> Column:
    idx = _rule_index(ua, OS_RULES) if idx is None else idx
    return _by_index(idx, [F.lit(name) for _, _, name, _ in OS_RULES], F.lit(UNKNOWN))


def os_version(ua: Column, idx: Column | None = None) -> Column:
    idx = _rule_index(ua, OS_RULES) if idx is None else idx
    versions = [_version(ua, vpat) if vpat else F.lit(None).cast("string") for _, _, _, vpat in OS_RULES]
    return _by_index(idx, versions, F.lit(None).cast("string"))


def agent_columns(ua_col: str = "ua") -> dict[str, Column]:
    """The four agent columns as self-contained expressions."""
    ua = F.coalesce(F.col(ua_col), F.lit(""))
    b_idx = _rule_index(ua, BROWSER_RULES)
    o_idx = _rule_index(ua, OS_RULES)
    return {
        "browsername": browser_name(ua, b_idx),
        "browserversion": browser_version(ua, b_idx),
        "osname": os_name(ua, o_idx),
        "osversion": os_version(ua, o_idx),
    }


_STAGED_CACHE: dict[tuple, tuple] = {}


def _staged_exprs(ua_col: str) -> tuple:
    """The index and output expressions, built once per JVM: they are pure
    column expressions (no DataFrame inside), so they can be reused, and
    building hundreds of nested Column objects costs py4j round trips."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    key = (ua_col, id(sc), sc.applicationId if sc else None)
    if key not in _STAGED_CACHE:
        ua = F.coalesce(F.col(ua_col), F.lit(""))
        idx = {"_bidx": _rule_index(ua, BROWSER_RULES), "_oidx": _rule_index(ua, OS_RULES)}
        b, o = F.col("_bidx"), F.col("_oidx")
        outs = {
            "browsername": browser_name(ua, b),
            "browserversion": browser_version(ua, b),
            "osname": os_name(ua, o),
            "osversion": os_version(ua, o),
        }
        _STAGED_CACHE[key] = (idx, outs)
    return _STAGED_CACHE[key]


def with_agent_columns(df: DataFrame, ua_col: str = "ua") -> DataFrame:
    """Add the four agent columns, matching each rule list once per row.

    The matching rule's index is its own column first: an index repeated in
    the later branches of a CASE would not be shared by subexpression
    elimination, and Catalyst does not inline a non-trivial column that is
    used several times.
    """
    idx, outs = _staged_exprs(ua_col)
    return df.withColumns(idx).withColumns(outs).drop("_bidx", "_oidx")
