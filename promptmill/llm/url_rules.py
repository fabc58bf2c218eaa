"""Allow and block rules for URLs, found through the rarest literal token of each rule."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.workspace import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)
#: The rule index is broadcast up to so many rules; beyond it Spark joins it by token.
MAX_BROADCAST_RULES = 50_000
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class UrlRule:
    """``kind`` host: ``text`` is a host and a path prefix (``example.com/en/``), for the host and its subdomains.

    ``kind`` pattern: ``text`` may stand anywhere in a URL; ``*`` is any text,
    ``^`` a separator or the end, ``||`` at the start any scheme and subdomain.
    Hosts and patterns are compared with A-Z in lower case, a rule's path as
    written (paths are case-sensitive).
    """

    verdict: str
    text: str
    kind: str = "host"

    @property
    def low(self) -> str:
        """The rule with A-Z in lower case, as URLs are compared for hosts, tokens and patterns."""
        return self.text.translate(_LOWER)

    @property
    def host(self) -> str | None:
        return self.low.split("/", 1)[0] if self.kind == "host" else None

    @property
    def path(self) -> str | None:
        return "/" + self.text.split("/", 1)[1] if self.kind == "host" else None

    @property
    def regex(self) -> str | None:
        """The pattern as a regular expression for URLs with A-Z in lower case."""
        if self.kind == "host":
            return None
        text, start = self.low, ""
        if text.startswith("||"):
            text, start = text[2:], r"^[^:]*://(?:[^/?#]*\.)?"
        parts = {"*": ".*", "^": "(?:[^a-z0-9_.%-]|$)"}
        return start + "".join(parts.get(c) or (c if c.isalnum() else "\\" + c) for c in text)

    @property
    def tokens(self) -> list[str]:
        """Runs of a-z and 0-9 that are whole tokens of every URL the rule can fit (URLs in lower case)."""
        low = self.low
        if self.kind == "host":
            # a path prefix may end inside a token
            return re.findall(r"[a-z0-9]+(?![a-z0-9]*$)", low) if low[-1:] != "/" else re.findall(r"[a-z0-9]+", low)
        text = low.replace("||", "^")
        return re.findall(r"(?<![a-z0-9*])(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text)


#: The rules given for this engine's own query.
BASE_RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)
#: Patterns for what no host rule decides.
PATTERN_RULES = tuple(
    UrlRule("block", text, "pattern")
    for text in (
        "||spam-farm.", "||cheap-pills.", "||adult-x.", "||casino.", "||free-money.",
        "/porn/", "/xxx/", "/casino/", "/viagra/", "/warez/", "/adult/", "://ads.", "/click-here/",
    )
) + (UrlRule("allow", "/sex-education/", "pattern"),)


def lower_ascii(column: Column | str) -> Column:
    return F.translate(column, UPPER, LOWER)


def url_host(url: str) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def url_path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _url_tokens(column: Column) -> Column:
    """The distinct tokens of a URL, and the empty one, under which rules without a token stand."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(lower_ascii(column), "[^a-z0-9]+")))


def rule_index(urls: DataFrame, rules: Sequence[UrlRule], url: str = "url") -> DataFrame:
    """The rules with ``token``, the literal token of theirs that the fewest of ``urls`` hold (ties: first by name)."""
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(i, r.kind, r.text, r.verdict, r.host, r.path, r.regex, r.tokens or [""]) for i, r in enumerate(rules)],
        "number int, kind string, rule string, rule_verdict string, rule_host string, rule_path string, "
        "regex string, tokens array<string>",
    )
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    if len(rules) <= MAX_BROADCAST_RULES:
        wanted = F.broadcast(wanted)
    held = urls.select(F.explode(_url_tokens(F.col(url))).alias("token"))
    counts = held.join(wanted, "token").groupBy("token").agg(F.count("*").alias("n"))
    ranked = table.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
    rarest = ranked.groupBy("number").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("least")
    )
    return table.drop("tokens").join(rarest.select("number", F.col("least.token").alias("token")), "number")


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule] = BASE_RULES + PATTERN_RULES, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the host rule that decides, or null) and ``verdict``.

    The longest fitting host rule decides. Where none fits, a fitting ``allow``
    pattern, else a fitting ``block`` pattern does, else ``default``. A null URL
    or one without ``://`` has empty host and path and fits no host rule.
    Repeated rows keep their number, an empty table stays empty, other columns
    stay and columns of the four names are replaced.

    Distinct URLs are cut into tokens; a token fetches the rules indexed by it
    and only those are tried, regular expressions last. What fits is written to
    the shared folder and joined back by URL, where Spark can split a hot URL.
    """
    urls = pages.select(F.col(f"`{url.replace('`', '``')}`").alias("__url")).where(F.col("__url").isNotNull()).distinct()
    index = rule_index(urls, rules, "__url")
    if len(rules) <= MAX_BROADCAST_RULES:
        index = F.broadcast(index)
    parts = urls.select("__url", url_host("__url").alias("h"), url_path("__url").alias("p"))
    asked = parts.select("*", F.explode(_url_tokens(F.col("__url"))).alias("token"))
    by_host = (F.col("kind") == "host") & F.col("p").startswith(F.col("rule_path")) & (
        (F.col("h") == F.col("rule_host")) | F.col("h").endswith(F.concat(F.lit("."), F.col("rule_host")))
    )
    by_pattern = (F.col("kind") == "pattern") & F.regexp_like(lower_ascii("__url"), F.col("regex"))
    fitting = asked.join(index, "token").where(by_host | by_pattern)
    decided = fitting.groupBy("__url").agg(
        F.max(
            F.when(F.col("kind") == "host", F.struct(F.length("rule").alias("size"), F.col("rule"), F.col("rule_verdict")))
        ).alias("__base"),
        F.min(F.when(F.col("kind") == "pattern", F.col("rule_verdict"))).alias("__pattern"),
    )
    decided = materialize(decided, "url-verdicts")
    # Internal names that no column of the pages has, so that any extra column passes through.
    tag = "__u"
    while any(name.startswith(tag) for name in pages.columns):
        tag += "_"
    decided = decided.select(*[F.col(c).alias(tag + c) for c in ("__url", "__base", "__pattern")])
    others = [F.col(f"`{name.replace('`', '``')}`") for name in pages.columns if name not in ("host", "path", "rule", "verdict")]
    at = F.col(f"`{url.replace('`', '``')}`")
    joined = pages.join(decided, at == F.col(tag + "__url"), "left")
    return joined.select(
        *others,
        url_host(at).alias("host"),
        url_path(at).alias("path"),
        F.col(tag + "__base.rule").alias("rule"),
        F.coalesce(F.col(tag + "__base.rule_verdict"), F.col(tag + "__pattern"), F.lit(default)).alias("verdict"),
    )


def url_report(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).drop("url")


def url_rules_sql(rules: Sequence[UrlRule] = BASE_RULES + PATTERN_RULES) -> str:
    """The same in SQL, with every rule tried on every URL."""

    def values(rows) -> str:
        return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)

    hosts = values((r.host, r.path, r.text, r.verdict) for r in rules if r.kind == "host")
    patterns = values((r.regex, r.verdict) for r in rules if r.kind == "pattern")
    return rf"""
WITH parts AS (
    SELECT page_id, row_number() OVER () AS n, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
        translate(coalesce(regexp_extract(url, '{HOST}', 1), ''), '{UPPER}', '{LOWER}') AS host,
        coalesce(regexp_extract(url, '{PATH}', 1), '') AS path
    FROM pages
), host_rules(rule_host, rule_path, rule, verdict) AS (VALUES {hosts}),
patterns(regex, verdict) AS (VALUES {patterns}),
base AS (
    SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts JOIN host_rules
        ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
    GROUP BY n
), others AS (
    SELECT n, min(verdict) AS verdict FROM parts JOIN patterns ON regexp_matches(low, regex) GROUP BY n
)
SELECT page_id, host, path, base.rule AS rule, coalesce(base.verdict, others.verdict, 'allow') AS verdict
FROM parts LEFT JOIN base USING (n) LEFT JOIN others USING (n)
"""
