"""URL filter rules, fetched by their rarest literal token. DataFrame functions only.

A rule is a host and path prefix or a pattern with ``*``. Both become a
regular expression over ``"." + host + path`` and a list of literal tokens
(runs of ASCII letters and digits) that every match holds. Each rule is
indexed by the one of its tokens that the fewest URLs have; a URL's tokens
fetch candidate rules, and only these run their expression. A rule without a
literal token is a candidate of every URL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.llm.tables import fresh

TOKEN = "[A-Za-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is what a verdict cites; ``length`` ranks host rules; ``tokens`` are in every match."""

    name: str
    verdict: str
    regex: str
    length: int
    tokens: tuple[str, ...]
    is_pattern: bool


def _whole_tokens(text: str, open_end: bool) -> tuple[str, ...]:
    """Runs in the rule's text that no wildcard can lengthen."""
    runs = [m for m in re.finditer(TOKEN, text) if text[m.start() - 1 : m.start()] != "*" and text[m.end() : m.end() + 1] != "*"]
    return tuple(dict.fromkeys(m.group() for m in runs if not (open_end and m.end() == len(text))))


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    host = host.lower()
    tail = "" if path else "(?:/|$)"
    return Rule(host + path, verdict, "(?s)^[^/]*" + re.escape("." + host + path) + tail, len(host + path), _whole_tokens("." + host + path, bool(path)), False)


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """Fits where the whole of ``"." + host + path`` matches; ``*`` is any text."""
    regex = "(?s)^" + ".*".join(map(re.escape, pattern.split("*"))) + "$"
    return Rule(pattern, verdict, regex, len(pattern), _whole_tokens(pattern, False), True)


#: Rules for hosts and paths: the longest that fits decides.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
#: Patterns that decide where no host rule fits; of several the longest, and without one the URL is allowed.
PATTERN_RULES = (
    pattern_rule("block", "*.adult-*"),
    pattern_rule("block", "*-bets.*"),
    pattern_rule("block", "*.spam-*"),
    pattern_rule("block", "*/wp-login.php*"),
)
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _literals(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A local table from literals, without a Python-side partition."""
    marks = ", ".join("(" + ", ".join(f":p{i}_{k}" for k in range(len(row))) + ")" for i, row in enumerate(rows))
    return spark.sql(f"SELECT * FROM VALUES {marks} AS rules({names})", args={f"p{i}_{k}": v for i, row in enumerate(rows) for k, v in enumerate(row)})


def _tokens(subject: Column, every: bool) -> Column:
    found = F.filter(F.array_distinct(F.split(subject, "[^A-Za-z0-9]+")), lambda t: t != "")
    return F.concat(found, F.array(F.lit(""))) if every else found


def rule_index(subjects: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(rule_no, token)``: the token of each rule that the fewest subjects have; empty for rules without one."""
    spark = subjects.sparkSession
    literals = _literals(spark, [(i, t) for i, rule in enumerate(rules) for t in (rule.tokens or ("",))], "rule_no, token")
    used = sorted({t for rule in rules for t in rule.tokens})
    if not used:
        return literals
    seen = subjects.select(F.explode(_tokens(F.col("subject"), False)).alias("seen"))
    counts = seen.join(_literals(spark, [(t,) for t in used], "used"), F.col("seen") == F.col("used")).groupBy("used").agg(F.count(F.lit(1)).alias("n"))
    ranked = literals.join(counts, F.col("token") == F.col("used"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = Window.partitionBy("rule_no").orderBy("n", F.length("token").desc(), "token")
    return ranked.withColumn("rank", F.row_number().over(order)).filter("rank = 1").select("rule_no", "token")


def judge(pages: DataFrame, rules: list[Rule] | None = None, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict (underscores are added where such columns exist).

    ``rule`` is the longest host rule that fits, ties to the smaller name, and
    null without one; the verdict is then the longest fitting pattern's, or
    ``default``. Equal URLs are judged once, so a URL that a third of all rows
    share costs one judgement; rows repeat as they are. Null, empty and
    malformed URLs have empty host and path and fit no host rule. No rules:
    all have the default. No rows: no rows.
    """
    rules = list(HOST_RULES + PATTERN_RULES if rules is None else rules)
    names = [fresh(pages, n) for n in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url_col).cast("string"))
    subject = fresh(pages, "_subject")
    split = pages.withColumns({names[0]: host, names[1]: path}).withColumn(subject, F.concat(F.lit("."), names[0], names[1]))
    if not rules:
        return split.withColumns({names[2]: F.lit(None).cast("string"), names[3]: F.lit(default)}).drop(subject)
    subjects = split.select(F.col(subject).alias("subject")).distinct()
    facts = _literals(pages.sparkSession, [(i, r.name, r.verdict, r.regex, r.length, r.is_pattern) for i, r in enumerate(rules)], "no, name, outcome, regex, length, is_pattern")
    index = rule_index(subjects, rules).join(facts, F.col("rule_no") == F.col("no"))
    asked = subjects.select("subject", F.explode(_tokens(F.col("subject"), not all(r.tokens for r in rules))).alias("asked"))
    fitting = asked.join(index, (F.col("asked") == F.col("token")) & F.expr("subject RLIKE regex"))
    # The smallest (-length, name) is the longest rule and among those the smaller name.
    rank = F.struct((-F.col("length")).alias("l"), "name", "outcome")
    best = fitting.groupBy(F.col("subject").alias("judged")).agg(
        F.min(F.when(~F.col("is_pattern"), rank)).alias("by_host"), F.min(F.when(F.col("is_pattern"), rank)).alias("by_pattern")
    )
    found = split.join(best, split[subject] == best["judged"], "left")
    verdict = reduce(lambda a, b: F.coalesce(a, b), [F.col("by_host.outcome"), F.col("by_pattern.outcome"), F.lit(default)])
    return found.select(*pages.columns, *names[:2], F.col("by_host.name").alias(names[2]), verdict.alias(names[3]))


def oracle() -> str:
    """The verdicts of the default rules in DuckDB's SQL."""
    hosts = ", ".join(f"('{r.verdict}', '{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}')" for r in HOST_RULES)
    likes = " OR ".join(f"'.' || host || path LIKE '{r.name.replace('*', '%')}'" for r in PATTERN_RULES)
    return f"""
WITH rules(outcome, rule_host, rule_path) AS (VALUES {hosts}),
cut AS (SELECT DISTINCT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT url, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
best AS (
  SELECT url, host, path, arg_min(rule_host || rule_path, (-length(rule_host || rule_path), rule_host || rule_path)) AS rule,
         arg_min(outcome, (-length(rule_host || rule_path), rule_host || rule_path)) AS outcome
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY url, host, path)
SELECT page_id, host, path, rule, CASE WHEN outcome IS NOT NULL THEN outcome WHEN {likes} THEN 'block' ELSE '{DEFAULT}' END AS verdict
FROM pages JOIN best ON pages.url IS NOT DISTINCT FROM best.url
"""
