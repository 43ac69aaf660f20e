"""Quality of documents by weak supervision: rules vote or abstain, EM tells how far to trust each.

``facts`` counts words, symbols, lines and repeats of each whole text, in one pass. Each rule of
``RULES`` reads one ratio of these: it votes *good* on one side of a band, *bad* on the
other, and abstains within it, or where the text is too short to tell. No rule is decisive.

The label model has a hidden label for each document and two accuracies for each rule: how
often it is right on good and on bad documents, when it votes at all. The votes of the
whole corpus are counted by their pattern (at most ``3 ** len(RULES)`` of them, whatever the size of the
corpus), and expectation-maximisation runs on the counts: posteriors of the patterns from
the accuracies, then accuracies and the share of good documents from the posteriors. ``PRIOR``
documents' worth of belief, a share of the corpus, keeps the labels' meaning and rules that
hardly ever vote in check. A document is kept if it passes ``base`` and its posterior probability of
being good reaches ``LEAST``: one odd ratio is outvoted, a few are not.

Null and empty texts have no words; only the length rule votes on them, and they fail ``base``.
Texts of any length are read whole; repeated rows count and are judged one by one; with an empty
table the accuracies are those believed beforehand, and the result is empty; further columns
are ignored by ``judged`` and kept by ``facts``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Words of a window that is a repeat if it comes twice.
WINDOW = 5
FACTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_closed_lines",
    "n_commonest", "n_doubled", "n_alnum", "n_capitals", "n_small",
]
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACE = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_CLOSED = tuple(c.encode() for c in ".!?:;…\"”’'»)。！？")


@dataclass(frozen=True)
class Rule:
    """Votes on ``share`` of ``of``: good up to ``good``, bad beyond ``bad``; reversed if ``bad`` is the lower."""

    name: str
    share: str
    of: str
    good: float
    bad: float
    #: Below so many of ``of`` the rule abstains.
    least: int = 1


#: Chosen by what the ratios mean in running text, wide of both kinds; EM weighs them.
RULES = [
    Rule("long enough", "n_words", "1", 100, 9.5, 0),
    Rule("few symbols", "n_symbols", "n_words", 0.02, 0.10, 10),
    Rule("few repeated lines", "n_dup_lines", "n_lines", 0.05, 0.30, 5),
    Rule("few repeated passages", "n_repeat_words", "n_words", 0.05, 0.20, 10),
    Rule("mostly small letters", "n_capitals", "n_capitals + n_small", 0.15, 0.40, 20),
    Rule("lines end like sentences", "n_closed_lines", "n_lines", 0.50, 0.10, 2),
    Rule("no word everywhere", "n_commonest", "n_words", 0.12, 0.25, 20),
    Rule("few doubled words", "n_doubled", "n_words", 0.03, 0.20, 10),
    Rule("mostly letters and digits", "n_alnum", "word_chars", 0.85, 0.75, 20),
    Rule("words not too long", "word_chars", "n_words", 10.0, 15.0, 10),
    Rule("words not too short", "word_chars", "n_words", 3.0, 2.0, 10),
]
#: Beforehand: the share of good documents, and how often a vote is right on good and on bad ones.
SHARE, ON_GOOD, ON_BAD = 0.8, 0.98, 0.4
PRIOR = 0.01
ROUNDS = 500
SETTLED = 1e-9
LEAST = 0.5


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that come twice or more, the first time included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.array([i for i, w in enumerate(windows) if counts[w] > 1])
    covered[at] += 1
    covered[at + WINDOW] -= 1  # ``at`` has no place twice
    return int((np.cumsum(covered)[:-1] > 0).sum())


def text_facts(text: bytes | None) -> tuple[int, ...]:
    """The counts of ``FACTS`` for a text in UTF-8."""
    if not text:
        return (0,) * len(FACTS)
    words = text.split()  # bytes split at exactly the six white-space characters of ASCII
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    capitals, small = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words), int(len(text) - kinds[_SPACE].sum() - kinds[0x80:0xC0].sum()), int(kinds[_SYMBOLS].sum()),
        len(lines) - len(set(lines)), repeat_words(words), len(lines),
        sum(line.rstrip().endswith(_CLOSED) for line in lines),
        max(Counter(words).values(), default=0), sum(map(eq, words, words[1:])),
        capitals + small + int(kinds[48:58].sum() + kinds[0xC0:].sum()), capitals, small,
    )


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in FACTS]))
def _facts(texts: pa.Array) -> pa.Array:
    rows = [text_facts(t) for t in texts.cast(pa.binary()).to_pylist()]
    table = np.array(rows, np.int64).reshape(-1, len(FACTS))
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(FACTS))], FACTS)


def facts(docs: DataFrame, into: str = "facts") -> DataFrame:
    """``docs`` with a struct column of the counts of its column ``text``."""
    return docs.withColumn(into, _facts("text"))


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 if the rule abstains; reads the columns of ``FACTS``."""
    of = F.expr(rule.of)
    ratio = F.col(rule.share) / F.greatest(of, F.lit(1))
    low = rule.good < rule.bad
    good = ratio <= rule.good if low else ratio >= rule.good
    bad = ratio > rule.bad if low else ratio < rule.bad
    told = of >= rule.least
    return F.when(told & good, 1).when(told & bad, -1).otherwise(0).cast("tinyint")


def base_failed() -> Column:
    """Too short, or over a fifth of the words repeat."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Model:
    """The share of good documents, and each rule's accuracy on good and on bad ones."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def evidence(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Logarithms of the odds of good: beforehand, by a good and by a bad vote of each rule."""
        return (
            float(np.log(self.share / (1 - self.share))),
            np.log(self.on_good / (1 - self.on_bad)), np.log((1 - self.on_good) / self.on_bad),
        )

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        start, up, down = self.evidence()
        return 1 / (1 + np.exp(-(start + (votes == 1) @ up + (votes == -1) @ down)))


def estimate(votes: np.ndarray, counts: np.ndarray) -> Model:
    """Expectation-maximisation on vote patterns (patterns x rules) and how often each occurs."""
    rules = votes.shape[1]
    model = Model(SHARE, np.full(rules, ON_GOOD), np.full(rules, ON_BAD))
    belief = PRIOR * max(1.0, counts.sum())
    good_votes, bad_votes = (votes == 1).astype(float), (votes == -1).astype(float)
    for _ in range(ROUNDS if len(votes) else 0):
        q = model.posterior(votes)
        good, bad = counts * q, counts * (1 - q)
        right, wrong = good @ good_votes, good @ bad_votes
        on_good = (right + belief * ON_GOOD) / (right + wrong + belief)
        right, wrong = bad @ bad_votes, bad @ good_votes
        on_bad = (right + belief * ON_BAD) / (right + wrong + belief)
        share = (good.sum() + belief * SHARE) / (counts.sum() + belief)
        after = Model(float(share), on_good, on_bad)
        moved = max(abs(share - model.share), np.abs(on_good - model.on_good).max(), np.abs(on_bad - model.on_bad).max())
        model = after
        if moved < SETTLED:
            break
    return model


def fit(counted: DataFrame) -> Model:
    """The label model of a table with the columns of ``FACTS``."""
    names = [f"v{i}" for i in range(len(RULES))]
    # A row for each pattern of votes: bounded by the rules, not by the corpus.
    rows = counted.select(*[vote(r).alias(n) for r, n in zip(RULES, names)]).groupBy(*names).count().orderBy(*names)
    table = np.array([tuple(r) for r in rows.collect()], np.int64).reshape(-1, len(RULES) + 1)
    return estimate(table[:, :-1], table[:, -1].astype(float))


def probability(model: Model) -> Column:
    """The posterior probability of being good, from the columns of ``FACTS``."""
    start, up, down = model.evidence()
    odds = F.lit(start)
    for rule, a, b in zip(RULES, up.tolist(), down.tolist()):
        odds = odds + F.when(vote(rule) == 1, F.lit(a)).when(vote(rule) == -1, F.lit(b)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the facts, base_failed, probability and kept of each row of ``docs`` (doc_id, text)."""
    counted = written(facts(docs.select("doc_id", "text"), "f").select("doc_id", "f.*"), "facts")
    chance = probability(fit(counted))
    return counted.withColumn("base_failed", base_failed()).withColumn("probability", chance).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= LEAST)
    )
