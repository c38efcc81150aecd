"""Quality rules as a short-circuit cascade.

Each rule looks at one document and rejects it or lets it pass. On a sample the rules' costs
and rejections are measured; the cascade then puts next the rule that rejects most of the
still surviving sample per second, and a document is tested only until the first rule rejects
it. The order decides what a document costs, never whether it is kept.

Word lists, line lists and counts are made when a rule first asks for them and shared by the
rules after it, so a rule's cost is what it adds after the ones before it.

A NULL text is an empty one. Documents without words have no repeated or odd words and pass the
ratio rules; the base rule rejects them.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from tallyforge.llm.words import find_words, map_column

MIN_WORDS = 50
REPEAT_WINDOW = 3
#: Rows on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000

_SYMBOLS = re.compile(r"[#*$%&|<>]")


class Document:
    """One text with its features, each computed when first read."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return find_words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len("".join(self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(_SYMBOLS.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(" \t\n\v\f\r")]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows that occur more than once."""
        words = self.words
        windows = list(zip(*(words[start:] for start in range(REPEAT_WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        covered, end = 0, 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                covered += start + REPEAT_WINDOW - max(start, end)
                end = start + REPEAT_WINDOW
        return covered

    @cached_property
    def n_letters(self) -> int:
        return sum(map(str.isalpha, self.text))

    @cached_property
    def n_upper(self) -> int:
        return sum(map(str.isupper, self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


#: Thresholds of widely used web-text filters, loosened so that prose in any language passes.
RULES = (
    Rule("too_short", lambda doc: doc.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda doc: 100 * doc.n_repeat_words > 50 * doc.n_words),
    Rule("symbols", lambda doc: 10 * doc.n_symbols > doc.n_words),
    Rule("duplicate_lines", lambda doc: 10 * doc.n_dup_lines > 4 * len(doc.lines)),
    Rule("word_length", lambda doc: not 2 * doc.n_words <= doc.word_chars <= 15 * doc.n_words),
    Rule("few_letters", lambda doc: 10 * doc.n_letters < 5 * doc.word_chars),
    Rule("upper_case", lambda doc: 10 * doc.n_upper > 6 * doc.n_letters),
)


@dataclass(frozen=True)
class Trial:
    """What one rule did to one sampled document: nanoseconds used alone, and the outcome."""

    cost: int
    rejected: bool


def order_rules(trials: Sequence[Sequence[Trial]], rules: Sequence[Rule]) -> list[Rule]:
    """Greedy order: next comes the rule with most rejections of surviving rows per cost.

    ``trials`` has one row per sampled document and one entry per rule. Rules that reject
    nothing of what is left follow, cheapest first. An empty sample leaves the order as given.
    """
    left, alive, order = list(range(len(rules))), list(trials), []
    while left:
        def merit(k: int) -> tuple[float, float]:
            cost = 1 + sum(row[k].cost for row in alive)
            return sum(row[k].rejected for row in alive) / cost, -cost

        best = max(left, key=merit) if alive else left[0]
        order.append(rules[best])
        left.remove(best)
        alive = [row for row in alive if not row[best].rejected]
    return order


def _try_rules(text: str | None, rules: Sequence[Rule]) -> list[Trial]:
    trials = []
    for rule in rules:
        doc = Document(text)
        started = time.perf_counter_ns()
        rejected = rule.rejects(doc)
        trials.append(Trial(time.perf_counter_ns() - started, rejected))
    return trials


def plan_cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 17
) -> list[Rule]:
    """Order ``rules`` by what they cost and reject on about ``sample_rows`` documents.

    The sample is measured on the executors; only times and outcomes come back.
    """
    rows = docs.count()
    sample = docs.select(text)
    if rows > sample_rows:
        sample = sample.sample(fraction=sample_rows / rows, seed=seed).limit(2 * sample_rows)
    fields = [StructField(f"cost{k}", LongType()) for k in range(len(rules))]
    fields += [StructField(f"rejected{k}", BooleanType()) for k in range(len(rules))]

    def measure(texts: list) -> list[list]:
        tried = [_try_rules(value, rules) for value in texts]
        columns = [[row[k].cost for row in tried] for k in range(len(rules))]
        return columns + [[row[k].rejected for row in tried] for k in range(len(rules))]

    measured = map_column(sample, text, fields, measure).collect()
    n = len(rules)
    return order_rules([[Trial(row[k], row[n + k]) for k in range(n)] for row in measured], rules)


def first_rejection(doc: Document, cascade: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects the document; the rules after it do not run."""
    return next((rule.name for rule in cascade if rule.rejects(doc)), None)


def apply_cascade(
    docs: DataFrame, cascade: Sequence[Rule], text: str = "text", keep_text: bool = False, features: Sequence[str] = ()
) -> DataFrame:
    """``docs`` with ``rejected_by`` (NULL when kept) and the named ``features`` of each document."""
    fields = [StructField("rejected_by", StringType())] + [StructField(name, LongType()) for name in features]

    def judge(texts: list) -> list[list]:
        found: list[list] = [[] for _ in fields]
        for value in texts:
            doc = Document(value)
            found[0].append(first_rejection(doc, cascade))
            for k, name in enumerate(features, 1):
                found[k].append(getattr(doc, name))
        return found

    return map_column(docs, text, fields, judge, keep_column=keep_text)


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document its counts, the base rule and the cascade's verdict."""
    cascade = plan_cascade(docs, rules)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = apply_cascade(docs.select("doc_id", "text"), cascade, features=counts)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", *counts, failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept")
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents no rule rejects, with their columns as they are; rows without words go."""
    # A name no input column has, so that an input may carry a column called rejected_by.
    staged = docs.select(F.struct("*").alias("row"), F.col("text").alias("judged_text"))
    judged = apply_cascade(staged, plan_cascade(docs, rules), text="judged_text")
    return judged.filter(F.col("rejected_by").isNull()).select("row.*")
