"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression together with the literal tokens that any match must contain as
whole tokens. Over the URLs at hand the rarest of a rule's tokens is found; the tokens of a URL
then fetch the few rules indexed under them, and only those run their expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import UPPER, scratch_names

TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path (or, for keywords, in the lower-cased URL)."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    weight: int
    whole_url: bool = False


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with all its subdomains, and a path prefix; the longest fitting rule wins."""
    pattern = rf"\A(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}"
    # The last token counts only where something ends it; a prefix may go on.
    ended = f"{host}/" + (path[1:] if path.endswith("/") else path[1:].rpartition("/")[0])
    tokens = tuple(sorted(set(re.findall(TOKEN, ended.lower()))))
    return Rule(host + path, pattern, tokens, verdict, len(host) + len(path))


def keyword_rule(words: str, verdict: str = "block") -> Rule:
    """Whole tokens in a row anywhere in the URL, such as "cheap pills"; yields to site rules."""
    tokens = words.lower().split()
    pattern = rf"(?<![a-z0-9]){'[^a-z0-9]+'.join(map(re.escape, tokens))}(?![a-z0-9])"
    return Rule(None, pattern, tuple(sorted(set(tokens))), verdict, 0, whole_url=True)


#: Words that mark a URL as unwanted where no site rule decides.
KEYWORDS = [
    "spam", "spam farm", "link farm", "cheap pills", "viagra", "cialis", "casino", "poker",
    "slots", "gambling", "betting", "porn", "xxx", "sex", "escort", "escorts", "nude",
    "camgirls", "hentai", "payday loan", "payday loans", "warez", "crack download", "malware",
    "phishing", "replica watches",
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without "://"."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def token_frequencies(urls: DataFrame, url: str, tokens: list[str]) -> dict[str, int]:
    """In how many of all URLs each token of a rule occurs; at most one row for each token."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    found = F.array_intersect(F.split(F.lower(F.col(f"`{url}`")), "[^a-z0-9]+"), wanted)
    rows = urls.select(F.explode(found).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def index_rules(rules: list[Rule], frequencies: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules under their rarest token; a rule without any token is kept under ""."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (frequencies.get(t, 0), t), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    default: str = "allow",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``pages`` (columns ``keep``, default all) with host, path, rule and verdict.

    Of the site rules that fit, the longest wins, then a keyword; of equals the first in
    ``rules``. ``rule`` is NULL where no site rule fits. NULL URLs and URLs without "://"
    have an empty host and path, match no site rule and get a keyword's verdict or
    ``default``. Repeated rows are judged each. Columns named like a result are replaced.
    The rules are the caller's list, so they are as bounded as any argument; the URLs are
    read twice, once for the token counts, and never shuffled by host.
    """
    results = ["host", "path", "rule", "verdict"]
    kept = [c for c in (keep or pages.columns) if c not in results]
    tokens = sorted({t for r in rules for t in r.tokens})
    index = index_rules(rules, token_frequencies(pages, url, tokens) if tokens else {})
    hidden_url, hidden_host, hidden_path = scratch_names(pages, "url", "host", "path")
    host, path = split_url(F.col(f"`{url}`"))
    source = pages.select(
        F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias(hidden_url),
        host.alias(hidden_host),
        path.alias(hidden_path),
        *[f"`{c}`" for c in kept],
    )
    schema = T.StructType(
        [pages.schema[c] for c in kept] + [T.StructField(c, T.StringType()) for c in results]
    )
    order = {rule: k for k, rule in enumerate(rules)}

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        split = re.compile(TOKEN).findall
        ready = {
            token: [(re.compile(r.pattern), r) for r in under] for token, under in index.items()
        }
        for batch in batches:
            names, verdicts = [], []
            for text, host, path in zip(*(batch.column(k).to_pylist() for k in range(3))):
                lowered, site = text.lower(), host + path
                candidates = [x for t in {"", *split(lowered)} for x in ready.get(t, ())]
                hits = [
                    r for p, r in candidates if p.search(lowered if r.whole_url else site)
                ]
                best = min(hits, key=lambda r: (-r.weight, order[r]), default=None)
                names.append(best.name if best else None)
                verdicts.append(best.verdict if best else default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], batch.column(1), batch.column(2)]
                + [pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=[*kept, *results],
            )

    return source.mapInArrow(judge, schema)
