"""URL filters: rules indexed by their rarest literal token.

A rule that can only match an address holding certain whole tokens (runs of letters and digits) is
filed under the one that the fewest addresses hold. An address looks up its tokens; only the rules
that they fetch run their regular expression. Rules without such a token run on every address.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A named rule on host + path (``site``) or on the lower-case address (``pattern``).

    ``tokens`` are whole tokens of every address that the rule can match.
    """

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    site: bool


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path of the address starts with ``path``."""
    whole = re.findall(TOKEN, host)
    # The last token of a path may go on in the address unless something follows it in the rule.
    whole += re.findall(f"{TOKEN}(?=[^a-z0-9])", path)
    return Rule(host + path, verdict, rf"(?s)\A(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(whole), True)


def phrase_rule(verdict: str, phrase: str) -> Rule:
    """Fits any address with the phrase of lower-case words, not inside longer words."""
    return Rule(
        phrase, verdict, rf"(?s)(?<![a-z0-9]){re.escape(phrase)}(?![a-z0-9])", tuple(re.findall(TOKEN, phrase)), False
    )


#: The rules of hosts and paths.
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)
#: Phrases of addresses that sell or spam; they decide where no rule of hosts and paths fits.
PHRASE_RULES = tuple(
    phrase_rule("block", p)
    for p in ("spam-farm", "cheap-pills", "casino", "xxx", "porn", "viagra", "click-bait", "free-download")
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty for NULL or an address without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rarest_tokens(pages: DataFrame, url: str, rules: Iterable[Rule]) -> dict[Rule, str | None]:
    """The token of each rule that the fewest addresses hold; all addresses are counted."""
    rules = list(rules)
    wanted = sorted({t for r in rules for t in r.tokens})
    held = F.array_distinct(F.regexp_extract_all(F.translate(F.col(url), UPPER, LOWER), F.lit(TOKEN), 0))
    held = F.array_intersect(held, F.array(*map(F.lit, wanted)) if wanted else F.array().cast("array<string>"))
    counted = pages.select(F.explode(held).alias("token")).groupBy("token").count()
    counts = {r["token"]: r["count"] for r in counted.collect()}  # at most one row for a rule's token
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None) for r in rules}


class Index:
    """Rules by their token; compiled where they are used."""

    def __init__(self, tokens: dict[Rule, str | None]):
        self.always = [r for r, t in tokens.items() if t is None]
        self.under: dict[str, list[Rule]] = {}
        for rule, token in tokens.items():
            if token is not None:
                self.under.setdefault(token, []).append(rule)

    def candidates(self, lower_url: str) -> Iterable[Rule]:
        yield from self.always
        for token in set(re.findall(TOKEN, lower_url)) & self.under.keys():
            yield from self.under[token]

    def judge(self, url: str | None, host: str, path: str, otherwise: str) -> tuple[str | None, str]:
        """(site rule or None, verdict): the longest site rule, else a blocking phrase, else ``otherwise``."""
        lower_url = (url or "").translate(_LOWER)
        site, phrases = None, []
        for rule in self.candidates(lower_url):
            if re.search(rule.regex, host + path if rule.site else lower_url):
                if not rule.site:
                    phrases.append(rule.verdict)
                elif site is None or (len(rule.name), rule.verdict, rule.name) > (len(site.name), site.verdict, site.name):
                    site = rule
        if site is not None:
            return site.name, site.verdict
        return None, max(phrases, default=otherwise)


_LOWER = str.maketrans(UPPER, LOWER)


def judged(
    pages: DataFrame,
    url: str = "url",
    rules: Iterable[Rule] = SITE_RULES + PHRASE_RULES,
    otherwise: str = "allow",
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    ``rule`` is the longest site rule that fits (of equals the blocking one) and gives the verdict.
    Else it is NULL, and a phrase in the address decides, blocking before allowing, or ``otherwise``.
    NULL addresses and those without ``://`` have empty host and path. Repeated rows all stay; an
    empty table gives an empty result. The rules are a parameter, so the index that goes to the
    tasks does not grow with the pages.
    """
    index = Index(rarest_tokens(pages, url, rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(urls: pd.Series, hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [index.judge(u, h, p, otherwise) for u, h, p in zip(urls, hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"), F.col(url).alias("judged url"))
    rows = rows.withColumn("found", judge("judged url", "host", "path"))
    return rows.select(*kept, "host", "path", "found.rule", "found.verdict")


ORACLE = r"""
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts
), hp AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM cut
), rules(rule_host, rule_path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM hp JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT hp.page_id, hp.host, hp.path, fits.rule,
       coalesce(fits.action, CASE WHEN regexp_matches(low,
         '(^|[^a-z0-9])(spam-farm|cheap-pills|casino|xxx|porn|viagra|click-bait|free-download)([^a-z0-9]|$)')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM hp LEFT JOIN fits USING (page_id)
"""
