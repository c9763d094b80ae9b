"""Quality rules, line first: every line is judged on its own, failing lines go, then documents that lost too much go.

A line fails when it is made of symbols (punctuation rule), when it is a menu (navigation rule) or when it says what
sites say on every page (boilerplate rule). A document is rejected when the words of its failing lines are more than
``max_lost`` of its words, or when it breaks a document rule: too few words, or too much of it in repeated runs of three words.

Texts are read whole, one row at a time inside Arrow batches; nothing is shuffled. Null and empty texts have no words
and are rejected for being too short; repeated rows get the same answer; extra columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import BLANK

SYMBOLS = "#*$%&|<>"

# What boilerplate lines contain, lower-cased.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "click here to subscribe", "cookie policy", "enable javascript", "javascript is disabled",
    "lorem ipsum", "privacy policy", "sign up for our newsletter", "terms and conditions", "terms of service", "terms of use",
)
# What separates the items of a menu line.
MENU = re.compile(r"\s(?:\||»|›|•|·|>|::)\s")
_BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class LineRules:
    """Limits. ``symbol_share``: symbols per word of a line; ``menu_items``: items a menu line has at least, of ``menu_words`` words each on average at most."""

    symbol_share: float = 0.5
    menu_items: int = 4
    menu_words: float = 3.0
    boilerplate_words: int = 40
    max_lost: float = 0.5
    min_words: int = 50
    max_repeated: float = 0.5


def line_fails(line: str, words: list[str], rules: LineRules) -> bool:
    """Whether a line with these words is removed."""
    n = len(words)
    marks = sum(map(line.count, SYMBOLS))
    if marks and marks > rules.symbol_share * n:
        return True
    if not any(map(str.isalnum, line)):
        return True
    items = len(MENU.findall(line)) + 1
    if items >= rules.menu_items and n <= (rules.menu_words + 1) * items:
        return True
    return n <= rules.boilerplate_words and _BOILER.search(line.lower()) is not None


def repeated_words(words: list) -> int:
    """Words inside runs of three words that occur twice or more, the first occurrence included."""
    runs = list(zip(words, words[1:], words[2:]))
    if len(set(runs)) == len(runs):
        return 0
    counts, covered, end = Counter(runs), 0, 0
    for i, run in enumerate(runs):
        if counts[run] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def judge(text: str | None, rules: LineRules) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept, cleaned)`` of one text."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    seen: set[str] = set()
    good: list[str] = []
    dup = lost = 0
    for line in text.split("\n"):
        own = line.encode().split()
        if own:
            dup += line in seen
            seen.add(line)
            if line_fails(line, own, rules):
                lost += len(own)
                continue
        good.append(line)
    repeat = repeated_words(words)
    failed = n < rules.min_words or repeat > rules.max_repeated * n
    return (
        n, len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)), dup, repeat, lost, failed,
        not failed and lost <= rules.max_lost * n, text if lost == 0 else "\n".join(good),
    )


_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_words long, base_failed boolean, kept boolean"


def line_quality(text: Column, rules: LineRules = LineRules(), cleaned: bool = False) -> Column:
    """A struct with the counts and the verdict for each text, and the ``cleaned`` text if asked for."""
    schema = _FIELDS + (", cleaned string" if cleaned else "")
    names = [f.split()[0] for f in schema.split(", ")]

    @F.pandas_udf(schema)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t, rules)[: len(names)] for t in texts], columns=names)

    return verdict.asNondeterministic()(text)  # evaluated once, also below a filter on its own result


def clean_documents(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with their failing lines removed; the other columns stay."""
    name = "__quality"
    while name in docs.columns:
        name += "_"
    judged = docs.withColumn(name, line_quality(F.col(text), rules, cleaned=True))
    out = [F.col(f"{name}.cleaned").alias(c) if c == text else F.col(c) for c in docs.columns]
    return judged.filter(F.col(f"{name}.kept")).select(*out)
