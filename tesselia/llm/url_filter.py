"""URL verdicts by pattern rules, indexed by each rule's rarest literal token.

A rule is an action with a regular expression over ``host path`` of a URL and the literal tokens that any match must
contain as whole tokens. Token counts over all URLs say which of a rule's tokens is the rarest; the rule is filed
under that one. The tokens of a URL fetch candidate rules and only these run their expression. Rules without a
whole token are tried on every URL.

The longest matching rule wins. A null URL, or one without ``://``, has an empty host and path and no tokens. The index is
sent to the executors in blocks of ``block`` rules, one pass a block, so that no broadcast outgrows its bound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow, pick

_TOKEN = re.compile(r"[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    action: str
    name: str
    pattern: str
    tokens: tuple[str, ...] = field(default=())
    rank: int = 0


def host_rule(action: str, host: str, path: str) -> Rule:
    """A host with its subdomains, and a prefix of the path. Tokens that the prefix may cut off don't count."""
    name = host + path
    whole = [m.group() for m in _TOKEN.finditer(name.lower()) if m.end() < len(name)]
    pattern = r"(?:[^\x00]*\.)?" + re.escape(host) + "\x00" + re.escape(path)
    return Rule(action, name, pattern, tuple(whole), len(name))


def word_rule(action: str, word: str) -> Rule:
    """A whole token anywhere in host or path, below every host rule."""
    return Rule(action, word, r"(?s:.*?)(?<![0-9a-z])" + re.escape(word) + r"(?![0-9a-z])", (word,), -1)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path: the text after the first ``://`` up to ``/?#``, then up to ``?#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs hold each token of the rules; over all URLs, summed before the shuffle. As long as the rules' tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.split(F.lower(F.concat_ws(" ", "host", "path")), "[^0-9a-z]+"))
    rows = urls.select(F.explode(tokens).alias("token")).filter(F.col("token").isin(wanted)).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


class Index:
    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list] = {}
        self.always: list = []
        for r in rules:
            entry = (r.rank, r.action, r.name, re.compile(r.pattern).match)
            if r.tokens:
                self.by_token.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(entry)
            else:
                self.always.append(entry)

    def best(self, host: str, path: str):
        found, subject = None, f"{host}\x00{path}"
        for entry in self.always + [e for t in set(_TOKEN.findall(subject.lower())) for e in self.by_token.get(t, ())]:
            if (found is None or entry[0] > found[0] or entry[0] == found[0] and entry[2] < found[2]) and entry[3](subject):
                found = entry
        return found


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url", block: int = 50_000) -> DataFrame:
    """``page_id``, host, path, the winning rule's action, name and rank (null without one), and verdict."""
    host, path = url_parts(F.col(url_col))
    urls = pick(pages, id_col, url_col, **{url_col: "string"}).select(id_col, host.alias("host"), path.alias("path"))
    counts = token_counts(urls, rules)
    schema = urls.schema.simpleString()[7:-1].replace(":", " ") + ", action string, rule string, rank int"
    blocks = [rules[i : i + block] for i in range(0, len(rules), block)] or [[]]
    out = urls.withColumns({"action": F.lit(None).cast("string"), "rule": F.lit(None).cast("string"), "rank": F.lit(None).cast("int")})
    for some in blocks:
        sent = urls.sparkSession.sparkContext.broadcast((some, {t: counts.get(t, 0) for r in some for t in r.tokens}))

        def make(sent=sent):
            index = Index(*sent.value)

            def f(batch: pa.RecordBatch) -> pa.RecordBatch:
                cols = [c.to_pylist() for c in batch.columns[1:]]
                for i, (h, p) in enumerate(zip(cols[0], cols[1])):
                    got = index.best(h, p)
                    if got and (cols[4][i] is None or got[0] > cols[4][i]):
                        cols[4][i], cols[2][i], cols[3][i] = got[:3]
                kinds = [pa.string()] * 4 + [pa.int32()]
                return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], batch.schema.names)

            return f

        out = map_arrow(out, make, schema)
    return out.withColumn("verdict", F.coalesce("action", F.lit(default)))
