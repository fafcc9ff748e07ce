"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression with the literal tokens that every URL it matches must contain whole. Tokens are counted
over all URLs, and each rule is entered in the index under its rarest literal. A URL's tokens fetch candidate rules by an
equality join; only those run their regular expression. Rules without any literal are candidates everywhere.

Patterns see host and path in one string, which is unambiguous as a host holds no slash. The rule with the highest
priority decides; rules for a host and a path outrank others, the longest first.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged by the rules that match the
empty string, normally none: allowed. Repeated rows and missing ids keep a row each. Without rules everything is allowed.
Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import lower_ascii, table, written

TOKEN_GAP = "[^a-z0-9]+"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
#: Rules of a host and path start here, so that they outrank pattern rules.
HOST_RULE = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regular expression over host and path; ``tokens`` occur whole in all it matches."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int


def host_rule(name: str, action: str) -> Rule:
    """``host/path``: fits the host and all its subdomains if the path starts with the rule's."""
    host, _, path = name.partition("/")
    # The end of the path is open, so its last token may go on in a URL.
    whole = re.split(TOKEN_GAP, f"{host}/{path}".lower())
    whole = whole if whole[-1] == "" else whole[:-1]
    literal = re.sub(r"([^A-Za-z0-9/])", r"\\\1", f"{host}/{path}")
    return Rule(name, action, rf"^([^/]*\.)?{literal}", tuple(t for t in whole if t), HOST_RULE + len(name))


def word_rule(name: str, action: str, phrase: str, priority: int) -> Rule:
    """The words of ``phrase``, in any case and joined by any one sign, standing free in host or path."""
    tokens = tuple(phrase.split())
    return Rule(name, action, r"(?i)(^|[^a-z0-9])" + "[^a-z0-9]".join(tokens) + r"([^a-z0-9]|$)", tokens, priority)


# The rules of hosts and paths that the query states.
HOST_RULES = [
    host_rule("org/", "allow"),
    host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"),
    host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
]

# Words of hosts and paths that are no use as training data.
BLOCKED_PHRASES = [
    "adult", "adult x", "spam farm", "casino", "porn", "xxx", "escort", "viagra", "betting", "poker", "torrent",
    "warez", "phishing", "malware", "click here", "login", "signin", "cart", "checkout", "wp admin", "wp login",
    "cgi bin", "sitemap xml", "robots txt",
]
PHRASE_RULES = [word_rule(p, "block", p, 100 + len(p)) for p in BLOCKED_PHRASES]


def with_target(pages: DataFrame, url: str = "url") -> DataFrame:
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    cut = pages.withColumns({"host": lower_ascii(part(HOST)), "path": part(PATH)})
    return cut.withColumn("_target", F.concat("host", "path"))


def _tokens(targets: DataFrame) -> DataFrame:
    """``_target, token``: each token of a target once."""
    tokens = F.array_distinct(F.split(F.lower("_target"), TOKEN_GAP))
    return targets.select("_target", F.explode(tokens).alias("token")).filter("token <> ''")


def rule_index(targets: DataFrame, rules: list[Rule]) -> DataFrame:
    """``token, name, action, pattern, priority``: each rule with literals under its rarest."""
    spark = targets.sparkSession
    schema = "name string, action string, pattern string, tokens array<string>, priority int"
    rows = [(r.name, r.action, r.pattern, list(r.tokens), r.priority) for r in rules]
    frame = spark.createDataFrame(rows, schema)
    literals = frame.select("*", F.explode("tokens").alias("token")).drop("tokens")
    counted = _tokens(targets).join(literals.select("token").distinct(), "token").groupBy("token").count()
    rarest = Window.partitionBy("name", "pattern").orderBy(F.coalesce("count", F.lit(0)), "token")
    index = literals.join(counted, "token", "left").withColumn("_n", F.row_number().over(rarest)).filter("_n = 1")
    return written(index.select("token", "name", "action", "pattern", "priority"), "rule-index")


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """The columns of ``pages`` with ``host, path, rule, action``: the deciding rule, or nulls.

    Distinct targets are judged once; their verdicts return to the pages by an equality join.
    """
    pages = with_target(pages, url)
    targets = pages.select("_target").distinct()
    candidates = _tokens(targets).join(rule_index(targets, rules), "token").drop("token")
    everywhere = [
        F.struct(*(F.lit(getattr(r, c)).alias(c) for c in ("name", "action", "pattern", "priority")))
        for r in rules if not r.tokens
    ]
    if everywhere:
        candidates = candidates.unionByName(targets.select("_target", F.inline(F.array(*everywhere))))
    best = F.max(F.struct("priority", "name", "action")).alias("_best")
    hits = candidates.filter(F.rlike("_target", F.col("pattern"))).groupBy("_target").agg(best)
    hits = written(hits.select("_target", F.col("_best.name").alias("rule"), F.col("_best.action").alias("action")),
                   "url-hits")
    return pages.drop("rule", "action").join(hits, "_target", "left").drop("_target")


_HOST_NAMES = [r.name for r in HOST_RULES]

OP3_SQL = """
with cut as (
  select page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
), ruled as (
  select *, case
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
  end as rule
  from cut
)
select page_id, host, path, rule, case
    when rule in ('org/', 'com/fr/') then 'allow'
    when rule is not null then 'block'
    when regexp_matches(host || path, '(^|[^a-z0-9])(PHRASES)([^a-z0-9]|$)', 'i') then 'block'
    else 'allow' end as verdict
from ruled
""".replace("PHRASES", "|".join(p.replace(" ", "[^a-z0-9]") for p in BLOCKED_PHRASES))


@query("op3_url_rules", OP3_SQL)
def op3(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, HOST_RULES + PHRASE_RULES)
    rule = F.when(F.col("rule").isin(_HOST_NAMES), F.col("rule"))
    verdict = F.coalesce("action", F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
