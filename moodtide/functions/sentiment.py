"""Ordered lexicon scoring as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import NamedTuple
from unicodedata import category

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """Texts holding any of ``terms`` get this label and score."""

    label: str
    score: float
    terms: Sequence[str]


# Fixed values. Order matters: the first rule that hits wins, so the last but one negative
# term never decides (it holds a positive one). Put a negation rule first to change that.
DEFAULT_RULES = (
    Rule("Positive", 0.8, ("开心", "高兴", "不错", "好")),
    Rule("Negative", -0.6, ("难过", "沮丧", "不好", "糟")),
)
DEFAULT_OTHERWISE = Rule("Neutral", 0.0, ())

Scorer = Callable[[Column], Column]


@dataclass(frozen=True)
class Lexicon:
    """A scorer: text column -> ``struct<score double, label string>``, by the first rule that hits.

    Terms are matched without regard to case: both they and the text are lowered, the text only where
    that can matter, as it takes longer than the matching.
    """

    rules: Sequence[Rule] = DEFAULT_RULES
    otherwise: Rule = DEFAULT_OTHERWISE

    def __post_init__(self) -> None:
        if not self.rules or any(not rule.terms for rule in self.rules):
            raise ValueError("every rule needs at least one term")
        lowered = tuple(rule._replace(terms=tuple(term.lower() for term in rule.terms)) for rule in self.rules)
        object.__setattr__(self, "rules", lowered)

    @property
    def case_matters(self) -> bool:
        """Whether lower-casing a text can change what is found in it. It cannot if the terms are
        made of letters without case: those stay as they are, and none comes out of another."""
        return any(category(char) != "Lo" for rule in self.rules for term in rule.terms for char in term)

    def fold(self, text: Column) -> Column:
        return F.lower(text) if self.case_matters else text

    def __call__(self, text: Column) -> Column:
        return self.match(self.fold(text))

    def match(self, text: Column) -> Column:
        """The outcome for a text that is folded already."""
        branches = None
        for rule in self.rules:
            hit = reduce(or_, (text.contains(term) for term in rule.terms))
            branches = F.when(hit, _outcome(rule)) if branches is None else branches.when(hit, _outcome(rule))
        return branches.otherwise(_outcome(self.otherwise))


def _outcome(rule: Rule) -> Column:
    return F.struct(F.lit(float(rule.score)).alias("score"), F.lit(rule.label).alias("label"))


def score_sentiment(df: DataFrame, message_col: str = "message", scorer: Scorer | None = None) -> DataFrame:
    """Add ``sentiment_score`` and ``sentiment_label``; every other column passes through.

    ``scorer`` takes the message and returns ``struct<score, label>``: a ``Lexicon``, by default the
    fixed rules, or a ``pandas_udf`` around a model. Reject null messages first (the ``quality``
    module): a lexicon finds them neutral. A lexicon's folding and matching stand in steps of
    their own, so that each runs once per row.
    """
    scorer = scorer or Lexicon()
    text, outcome = F.col(message_col), scorer
    if isinstance(scorer, Lexicon):
        text, outcome = scorer.fold(text), scorer.match
    return (
        df.withColumn("_text", text)
        .withColumn("_mood", outcome(F.col("_text")))
        .withColumns({"sentiment_score": F.col("_mood.score"), "sentiment_label": F.col("_mood.label")})
        .drop("_text", "_mood")
    )


def negative_messages(scored: DataFrame, message_col: str = "message") -> DataFrame:
    """The audit list: user, score and text of every message scored below zero (F2)."""
    return scored.filter(F.col("sentiment_score") < 0).select("user_id", "sentiment_score", message_col)
