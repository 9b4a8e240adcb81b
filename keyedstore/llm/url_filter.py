"""URL filters: a sort-merge range join of urls with nested rules.

A host becomes a canonical key, its labels reversed and each closed by a full
stop (www.example.com -> com.example.www.).  A rule's key then covers an interval
of keys, all that start with it, and rules of parent domains hold those of
subdomains.  Urls are sorted by key within the partition they were read in and
swept together with the sorted rules; a stack keeps the rules whose interval is
open, innermost on top.  Urls are never dealt out by host, so a hot host is no
hot task.  Rules come in slices of at most `slice_rules`, each with its own sweep
over the sorted urls, so that a rule set of any size needs bounded memory.

A rule fits its host and all subdomains if the url's path starts with the rule's.
The longest rule (host and path) wins; of equally long ones the longer host's.
Urls that no rule fits get the default verdict.  A url that is null or has no
`://` has an empty host and path.  Repeated rows are judged one by one; a null page_id
stays null.  Extra
columns are ignored; an empty table gives no rows; without rules all get the
default.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, named, renamed

SLICE_RULES = 200_000


def key_of(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split("."))) if host else ""


def sweep(keys: list[str], paths: list[str], rules: list[tuple[str, str, str, str]]) -> list[tuple[str, str] | None]:
    """For urls sorted by key: the winning rule's name and verdict.  rules: (key, host, path, verdict), sorted."""
    out: list[tuple[str, str] | None] = []
    stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
    at = 0
    for key, path in zip(keys, paths):
        while stack and not key.startswith(stack[-1][0]):  # its interval has ended
            stack.pop()
        while at < len(rules) and rules[at][0] <= key:
            k, host, _, _ = rules[at]
            own: dict[str, tuple[str, str]] = {}
            while at < len(rules) and rules[at][0] == k:
                _, _, p, verdict = rules[at]
                own.setdefault(p, (f"{host}{p}", verdict))
                at += 1
            if key.startswith(k):
                stack.append((k, own, sorted({len(p) for p in own}, reverse=True)))
        best: tuple[str, str] | None = None
        for _, own, lengths in reversed(stack):  # innermost first: it wins ties
            for n in lengths:
                if n <= len(path) and (hit := own.get(path[:n])):
                    if best is None or len(hit[0]) > len(best[0]):
                        best = hit
                    break
        out.append(best)
    return out


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", slice_rules: int = SLICE_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict.  rules: (host, path, verdict); of equal host and path the first holds."""
    host, path = (F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)([^?#]*)", i) for i in (1, 2))
    df = named(pages, "url", key="page_id").select("page_id", "nameless", F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"))
    df = df.withColumn("key", F.when(F.col("host") == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split("host", r"\.", -1)), "."), F.lit("."))))
    df = df.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}).sortWithinPartitions("key")
    order = sorted(range(len(rules)), key=lambda i: (key_of(rules[i][0]), i))
    held = [(key_of(rules[i][0]), *rules[i]) for i in order if rules[i][0]]
    for i in range(0, len(held), slice_rules):
        part = held[i : i + slice_rules]

        def run(batches: Iterator[pd.DataFrame], part=part) -> Iterator[pd.DataFrame]:
            for p in batches:  # the partition is sorted, so each batch is
                got = sweep(p["key"].tolist(), p["path"].tolist(), part)
                rule, verdict = [], []
                for was, its, x in zip(p["rule"], p["verdict"], got):
                    better = x is not None and (not isinstance(was, str) or len(x[0]) > len(was))
                    rule.append(x[0] if better else was)
                    verdict.append(x[1] if better else its)
                yield p.assign(rule=rule, verdict=verdict)

        df = df.mapInPandas(run, "page_id long, nameless boolean, host string, path string, key string, rule string, verdict string")
    return renamed(df, "page_id").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
