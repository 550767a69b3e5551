"""URL filters: allow and block rules, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models, of URLs that rules accept and of those
that they reject, give the log-likelihood difference per character.  The cut is the
value that balances the two error rates on labelled URLs that the models did not see.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.text import fields_of, lower_ascii, map_rows

#: (verdict, host, path) of each rule.
Rule = tuple[str, str, str]

#: Labelled URLs of each class that the classifier is fitted on; every fourth calibrates the cut.
SAMPLE = 6000
ORDER = 4
_END = "\x03"


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host and path; both are empty for a null url and one without ``://``."""
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url_col), F.lit(""))
    return pages.withColumns(
        {"host": lower_ascii(F.regexp_extract(url, parts, 1)), "path": F.regexp_extract(url, parts, 2)}
    )


def _fits(rule: Rule) -> Column:
    _, host, path = rule
    of_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
    return of_host & F.col("path").startswith(path)


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the longest fitting rule and its verdict; of equally long ones block wins."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r))
    none = F.lit(None).cast("string")

    def first(value):
        return reduce(lambda out, r: F.when(_fits(r), F.lit(value(r))).otherwise(out), reversed(ordered), none)

    return pages.withColumns({"rule": first(lambda r: r[1] + r[2]), "by_rule": first(lambda r: r[0])})


class Markov:
    """Interpolated (Witten-Bell) character model over all orders up to ``order``."""

    def __init__(self, texts: Iterable[str], order: int = ORDER):
        self.order = order
        self.after: dict[str, Counter] = defaultdict(Counter)
        for text in texts:
            padded = text + _END
            for i, c in enumerate(padded):
                for k in range(min(order, i) + 1):
                    self.after[padded[i - k : i]][c] += 1
        self.after = {context: dict(n) for context, n in self.after.items()}
        self.totals = {context: sum(n.values()) for context, n in self.after.items()}
        self.known: dict[str, float] = {}

    def chance(self, context: str, c: str) -> float:
        p = 1 / 0x110000
        for k in range(len(context) + 1):
            n = self.after.get(context[len(context) - k :])
            if n is None:
                break
            total = self.totals[context[len(context) - k :]]
            p = (n.get(c, 0) + len(n) * p) / (total + len(n))
        return p

    def score(self, text: str) -> float:
        """Log-likelihood with the end mark."""
        padded, out = text + _END, 0.0
        for i in range(len(padded)):
            gram = padded[max(0, i - self.order) : i + 1]
            value = self.known.get(gram)
            if value is None:
                value = math.log(self.chance(gram[:-1], gram[-1]))
                if len(self.known) < 200_000:
                    self.known[gram] = value
            out += value
        return out


class RatioFilter:
    """Allow or block by the difference of two models per character."""

    def __init__(self, accepted: Sequence[str], rejected: Sequence[str]):
        fit = [[t for i, t in enumerate(own) if i % 4] for own in (accepted, rejected)]
        check = [own[::4] for own in (accepted, rejected)]
        self.models = [Markov(own) for own in fit] if all(fit) else None
        self.cut = self._balanced([[self.difference(t) for t in own] for own in check]) if self.models else 0.0

    @staticmethod
    def _balanced(scores: list[list[float]]) -> float:
        """The cut where the share of accepted URLs below equals that of rejected ones above."""
        good, bad = map(sorted, scores)
        best, cut = math.inf, 0.0
        values = sorted({*good, *bad})
        for low, high in zip(values, values[1:]):
            mid = (low + high) / 2
            wrong = sum(x < mid for x in good) / len(good), sum(x > mid for x in bad) / len(bad)
            if max(wrong) < best:
                best, cut = max(wrong), mid
        return cut

    def difference(self, text: str) -> float:
        yes, no = self.models
        return (yes.score(text) - no.score(text)) / (len(text) + 1)

    def verdict(self, text: str) -> str:
        """Without labelled URLs of both classes everything is allowed."""
        return "allow" if self.models is None or self.difference(text) >= self.cut else "block"


def judge(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", sample: int = SAMPLE
) -> DataFrame:
    """One row per page row: id, host, path, rule, verdict.

    The models are fitted on at most ``sample`` distinct URLs of each verdict, those
    with the least hashes.  A null url is judged as an empty one.
    """
    rows = with_rule(with_host_and_path(pages.select(F.col(id_col), F.col(url_col).alias("url"))), rules)
    whole = F.lower(F.coalesce("url", F.lit("")))
    # What follows the first mark, other URLs inside included; all of it where there is none.
    text = F.regexp_replace(whole, "^(?s:.*?)://", "")

    def labelled(verdict: str) -> list[str]:
        own = rows.filter(F.col("by_rule") == verdict).select(text.alias("text"))
        return [r.text for r in own.distinct().orderBy(F.xxhash64("text"), "text").limit(sample).collect()]

    judge_text = RatioFilter(labelled("allow"), labelled("block"))

    def worker(batches):
        model = judge_text
        for b in batches:
            yield {n: b[n] for n in (id_col, "host", "path", "rule")} | {
                "verdict": [v or model.verdict(t) for v, t in zip(b["by_rule"], b["_text"])]
            }

    fields = [*fields_of(rows, id_col, "host", "path", "rule"), T.StructField("verdict", T.StringType())]
    asked = F.when(F.col("by_rule").isNull(), text)
    return map_rows(rows.select(id_col, "host", "path", "rule", "by_rule", asked.alias("_text")), fields, worker)
