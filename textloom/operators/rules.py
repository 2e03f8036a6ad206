"""Normalization by a table of rules ``(sheet, ord, pattern, replacement)``."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.tokens import detokenize
from textloom.functions.words import strip

def usable_rules(rules: DataFrame) -> DataFrame:
    """Rules with a pattern, each pattern and replacement once per sheet, at its first place.

    Both sides are stripped, but for those of ``transform``; a missing replacement deletes what the pattern finds.
    """
    raw = F.col("sheet") == "transform"
    side = lambda name: F.when(raw, F.col(name)).otherwise(strip(F.col(name)))
    rows = rules.select("sheet", side("pattern").alias("pattern"), F.coalesce(side("replacement"), F.lit("")).alias("replacement"), "ord")
    return rows.filter("pattern is not null and pattern <> ''").groupBy("sheet", "pattern", "replacement").agg(F.min("ord").alias("ord"))


def rule_list(rules: DataFrame, bel: bool = False, exact: bool = False) -> list[tuple[str, str, str]]:
    """``(kind, pattern, replacement)`` in the order of application: ``error`` and ``RAG_fc`` as one set, on request
    ``exact``, and with ``bel`` the ``transform`` expressions. The table is a hand-written one; it is read whole."""
    rows = usable_rules(rules).collect()
    order = {"error": 0, "RAG_fc": 1, "exact": 2, "transform": 3}
    out, seen = [], set()
    for r in sorted((r for r in rows if r.sheet in order), key=lambda r: (order[r.sheet], r.ord, r.pattern)):
        kind = "word" if r.sheet in ("error", "RAG_fc") else "exact" if r.sheet == "exact" else "transform"
        if (kind, r.pattern, r.replacement) in seen or kind == "transform" and not bel or kind == "exact" and not exact:
            continue
        seen.add((kind, r.pattern, r.replacement))
        out.append((kind, r.pattern, r.replacement))
    return out


def word_pattern(pattern: str) -> str:
    """The pattern between word boundaries; its first letter may be small or a capital."""
    first = pattern[0]
    head = f"[{first.upper()}{first.lower()}]" if first.upper() != first.lower() else regex.escape(first)
    return rf"\b{head}{regex.escape(pattern[1:])}\b"


class Rules:
    """A rule table made ready: the same engine for tables of every size.

    A word rule whose first match begins the text with a capital writes all its matches with a capital and the rest small. A
    transform is an expression with references to its groups and strips the text afterwards.
    """

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.steps = []
        for kind, pattern, replacement in rules:
            if kind == "transform":
                self.steps.append((None, regex.compile(pattern), replacement, None))
            else:
                # a literal that every match contains spares most texts the expression
                self.steps.append((pattern[1:], regex.compile(word_pattern(pattern)), replacement, replacement.capitalize()))

    def apply(self, text: str) -> str:
        for needle, pattern, plain, capital in self.steps:
            if capital is None:
                text = pattern.sub(plain, text).strip()
            elif needle in text:
                m = pattern.search(text)
                if m:
                    out = capital if m.start() == 0 and m[0][0].isupper() else plain
                    text = pattern.sub(lambda _: out, text)
        return text


def normalize(c: Column, rules: list[tuple[str, str, str]], detok: bool = False) -> Column:
    """A line, stripped, detokenized on request, then every rule in order, in Arrow batches. Null stays null."""
    out = strip(c)
    if detok:
        out = detokenize(out)
    if not rules:
        return out

    def run(s: pd.Series) -> pd.Series:
        ready = Rules(rules)
        return s.map(ready.apply, na_action="ignore")

    return F.pandas_udf(run, StringType())(out)
