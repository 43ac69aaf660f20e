"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

A text is a bag of *units*: its words in lower case with everything but letters taken
out (so ``i-d.i*o t``-like spellings join up), and runs of single letters read as one
word. Two units are compared by the string subsequence kernel: all common subsequences
of ``ORDER`` letters, each weighted by ``DECAY`` to the power of the length it spans in
both, normalised. Gaps and inserted characters lower the value but do not destroy it.

Marks are units that stand out in labelled toxic texts: those with much evidence; a cover,
each with evidence from texts that none before accounts for, however rare it is beside
the commonest; and units like these with evidence of their own. A unit is no mark if its texts
are copies of each other, or if so many clean texts hold it that it cannot make a text toxic
(``PURITY``): such a unit is known to be harmless, whatever it resembles. Landmarks are the marks
and their look-alikes that stand out in clean texts. The Nyström map ``K_mm^(-1/2) k(u, landmarks)``
makes the kernel a vector product; a linear SVM is trained on it by multiple-instance rounds: a toxic
text is represented by its most toxic unit, clean texts by their hardest units. A text's score is a
logistic function of its largest unit value, where marks count as much as the surest of them. It is
fitted on the training texts as if unseen: what a clean text alone tells of its units is left out.

The kernel is an inner product of vectors with one component for each three letters. So
landmarks, Nyström map and SVM weights fold into one vector, and a unit's value is the sum of its
components in that, over its own norm: exact, whatever the number of landmarks. A unit is compared
through ``windows`` of ``LONGEST`` letters, so an insult in a long run of letters stands out, too.

The fit takes a bounded sample of labelled rows (``SAMPLE`` toxic and ``CLEAN`` others, by hash), and
of the harmless units in it the ``HARD`` most alike a landmark. Scoring reads every whole text once,
without a shuffle. The model is a few hundred kilobytes.

Null and empty texts have no units and get the score of a text without toxic units.
Texts of any length are read whole; repeated rows give repeated results; with no
labelled rows of both kinds all scores are 0; an empty table gives an empty table;
labels with a null id or label are not used; further columns do no harm.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2_000
#: Clean texts are sampled more: what they hold is known to be harmless.
CLEAN = 6_000
ORDER = 3
DECAY = 0.7
CLOSE = 0.75
FAMILY = 0.5
EVIDENCE = 12.0
#: An insult is taken to make at least this share of the texts that hold it toxic.
PURITY = 0.95
SHARE = 0.05
HARD = 1_500
LONGEST = 20
CHUNK = 2_000
ROUNDS = 3
COST = 10.0
#: Weight of all altered marks together in the logistic fit, against the toxic texts'.
ALTERED = 0.02
CACHED_UNITS = 400_000
THRESHOLD = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SPELLED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\W\d_]{1,3}[^\W\d_](?![^\W\d_])){2,}")


def units(text: str) -> set[str]:
    """Words of letters only, and runs of single letters as one word; ends are marked."""
    text = text.lower()
    tokens = set(text.split())
    found = set(filter(str.isalpha, tokens))
    for token in tokens - found:
        parts = _LETTERS.findall(token)
        found.update(parts)
        if len(parts) > 1:
            found.add("".join(parts))
    if sum(map((1).__eq__, map(len, found))) > 2:
        found.update(_NOT_LETTERS.sub("", run) for run in _SPELLED.findall(text))
    return {f"^{f}$" for f in found if len(f) >= ORDER}


def _codes(words: list[str]) -> np.ndarray:
    """Letters as numbers: one row a word, all words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


def _subsequences(same: np.ndarray) -> np.ndarray:
    """Lodhi's recursion for many pairs: ``same[i, j]`` tells which pairs have equal letters there."""
    width, other, n = same.shape
    before = np.ones((width + 1, other + 1, n))
    for _ in range(ORDER - 1):
        longer = np.zeros_like(before)
        for i in range(1, width + 1):
            run = np.zeros(n)
            for j in range(1, other + 1):
                run *= DECAY
                run += DECAY**2 * same[i - 1, j - 1] * before[i - 1, j - 1]
                longer[i, j] = DECAY * longer[i - 1, j] + run
        before = longer
    return DECAY**2 * (same * before[:-1, :-1]).sum((0, 1))


def _by_length(words: list[str]):
    """Places of words of equal length, at most ``CHUNK`` at a time."""
    lengths = np.fromiter(map(len, words), int, len(words))
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        for at in range(0, len(group), CHUNK):
            yield group[at:at + CHUNK]


def kernel(words: list[str], landmark: str) -> np.ndarray:
    """Unnormalised kernel of each word with one landmark."""
    out = np.zeros(len(words))
    letters = [ord(c) for c in landmark]
    for at in _by_length(words) if words else ():
        codes = _codes([words[i] for i in at]).T
        out[at] = _subsequences(np.stack([codes == c for c in letters], 1))
    return out


def self_kernel(words: list[str]) -> np.ndarray:
    """Unnormalised kernel of each word with itself."""
    out = np.zeros(len(words))
    for at in _by_length(words) if words else ():
        codes = _codes([words[i] for i in at]).T
        out[at] = _subsequences(codes[:, None] == codes[None, :])
    return out


def windows(word: str) -> list[str]:
    """What of a word is compared: stretches of ``LONGEST`` letters that cover it, itself if it has no more."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i:i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


@cache
def _places(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of three letters in a word of this length, and the weight of their span."""
    i, j, k = np.array(list(combinations(range(length), ORDER)), np.int64).reshape(-1, ORDER).T
    return np.stack((i, j, k)), DECAY ** (k - i + 1.0), np.arange(length)


class Letters:
    """The letters of some words, numbered; all others are 0 and weigh nothing."""

    def __init__(self, words: list[str]):
        self.known = np.array(sorted({ord(c) for w in words for c in w}), np.uint32)
        self.size = len(self.known) + 1

    def triples(self, words: list[str]) -> np.ndarray:
        """Numbers of all three-letter subsequences of words of one length."""
        codes = _codes(words)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        own = np.where(self.known[at] == codes, at + 1, 0)
        i, j, k = _places(codes.shape[1])[0]
        return (own[:, i] * self.size + own[:, j]) * self.size + own[:, k]

    def folded(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """One weight a triple: the weighted sum of the words' vectors of subsequences."""
        out = np.zeros(self.size ** ORDER)
        for word, weight in zip(words, weights):
            if len(word) >= ORDER:
                np.add.at(out, self.triples([word])[0], weight * _places(len(word))[1])
        return out

    def sums(self, words: list[str], tables: list[np.ndarray]) -> np.ndarray:
        """Inner products of the words' vectors with folded ones: words x tables."""
        out = np.zeros((len(words), len(tables)))
        for at in _by_length(words) if words else ():
            length = len(words[at[0]])
            if length < ORDER:
                continue
            spans = _places(length)[1]
            step = max(1, 1_000_000 // len(spans))
            for start in range(0, len(at), step):
                part = at[start:start + step]
                found = self.triples([words[i] for i in part])
                for t, table in enumerate(tables):
                    out[part, t] = table[found] @ spans
        return out


def similarities(words: list[str], landmarks: list[str], norms: np.ndarray) -> np.ndarray:
    """Normalised kernel values, words x landmarks."""
    if not words or not landmarks:
        return np.zeros((len(words), len(landmarks)))
    letters = Letters(landmarks)
    sums = letters.sums(words, [letters.folded([m], np.ones(1)) for m in landmarks])
    own = np.ones(len(words))
    rows = np.flatnonzero(sums.any(1))
    own[rows] = self_kernel([words[i] for i in rows])
    return sums / np.sqrt(norms[None, :] * own[:, None])


@dataclass(frozen=True)
class Model:
    letters: Letters
    folded: np.ndarray  # one weight a triple: the SVM's weights through the Nyström map and all landmarks
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    harmless: frozenset[str] = frozenset()  # look-alikes known from clean texts
    marks: frozenset[str] = frozenset()  # units known from toxic texts, all of value ``sure`` at least
    sure: float = 0.0

    def values(self, words: list[str]) -> np.ndarray:
        """The SVM's value of each word; where the landmarks' sum is not above zero, the bias."""
        sums = np.maximum(0, self.letters.sums(words, [self.folded])[:, 0])
        rows = np.flatnonzero(sums)
        if len(rows):
            sums[rows] /= np.sqrt(self_kernel([words[i] for i in rows]))
        sums += self.bias
        met = [i for i, w in enumerate(words) if w in self.marks]
        sums[met] = np.maximum(sums[met], self.sure)
        return sums

    def probability(self, value: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * value + self.shift))))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Linear SVM with hinge loss, by dual coordinate descent; the last column is the bias."""
    weights, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    square = (x * x).sum(1) + 1e-12
    order = np.random.default_rng(0)
    for _ in range(rounds):
        changed = 0.0
        for i in order.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ weights) - 1) / square[i], 0), cost[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                changed = max(changed, abs(new - alpha[i]))
                alpha[i] = new
        if changed < 1e-4:
            break
    return weights


def _logistic(value: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Platt's fit by Newton steps, with his smoothed targets; each example counts by its share."""
    n1, n0 = (share * y).sum(), (share * (1 - y)).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([value, np.ones(len(value))])
    w = np.array([0.0, math.log((n1 + 1) / (n0 + 1))])

    def loss(w):
        z = x @ w
        return (share * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * w @ w

    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ w)))
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (share * (p - target)) + 1e-3 * w)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > loss(w):
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    return float(w[0]), float(w[1])


def _evidence(inside: int, outside: int, n1: int, n0: int) -> float:
    """Signed likelihood ratio of a unit's rates in the two kinds of text."""
    a, b = (inside + 0.5) / (n1 + 1), (outside + 0.5) / (n0 + 1)
    return inside * math.log(a / b) if a > b else 0.0


def _harmless(inside: int, outside: int, n1: int, n0: int) -> bool:
    """Whether texts with the unit are likelier toxic at the common rate than at ``PURITY``."""
    common = min(0.5, n1 / (n1 + n0))
    return outside * math.log((1 - common) / (1 - PURITY)) > inside * math.log(PURITY / common)


def _of_copies(bags: list[list[str]]) -> bool:
    """Whether most of what these texts hold is held by four in five of them: copies, whose every unit looks telling."""
    counts = Counter()
    for bag in bags:
        counts.update(bag)
    shared = sum(n for n in counts.values() if 5 * n >= 4 * len(bags))
    return 2 * shared > sum(counts.values())


def _cover(bags: list[list[str]], likely: list[str], outside: Counter, n1: int, n0: int) -> list[str]:
    """Units that account for the toxic texts: each has its evidence from texts that none before is in."""
    holds = {u: set() for u in likely}
    for i, bag in enumerate(bags):
        for u in bag:
            if u in holds:
                holds[u].add(i)
    chosen: list[str] = []
    left = {u: _evidence(len(own), outside[u], n1, n0) for u, own in holds.items()}
    while left:
        best = min(left, key=lambda u: (-left[u], u))
        if left[best] < EVIDENCE:
            break
        chosen.append(best)
        gone = set(holds[best])
        for u in list(left):
            if holds[u] & gone:
                holds[u] -= gone
                left[u] = _evidence(len(holds[u]), outside[u], n1, n0)
            if left[u] < EVIDENCE:
                del left[u]
    return chosen


def _spread_out(marks: list[str]) -> list[str]:
    """Landmarks among the marks, in order, leaving out those close to one chosen before."""
    chosen: list[str] = []
    closest = np.zeros(len(marks))
    for i, mark in enumerate(marks):
        if closest[i] < CLOSE:
            chosen.append(mark)
            own = self_kernel([mark])
            closest = np.maximum(closest, similarities(marks, [mark], own)[:, 0])
    return chosen


def fit(texts: list[str], toxic: list[int]) -> Model | None:
    """Model from labelled texts; None if one of the labels does not occur."""
    y = np.array(toxic)
    if not y.sum() or y.all():
        return None
    same: dict[str, str] = {}  # one string a unit, however many texts hold it
    bags = [sorted({same.setdefault(w, w) for u in units(t or "") for w in windows(u)}) for t in texts]
    inside, outside = Counter(), Counter()
    for bag, label in zip(bags, y):
        (inside if label else outside).update(bag)
    n1, n0 = int(y.sum()), len(y) - int(y.sum())

    def evidence(u: str) -> float:
        return _evidence(inside[u], outside[u], n1, n0)

    def harmless(u: str) -> bool:
        return _harmless(inside[u], outside[u], n1, n0)

    likely = sorted((u for u in inside if evidence(u) >= EVIDENCE and not harmless(u)),
                    key=lambda u: (-evidence(u), u))
    holding = {u: [] for u in likely}
    for bag in (bag for bag, label in zip(bags, y) if label):
        for u in bag:
            if u in holding:
                holding[u].append(bag)
    likely = [u for u in likely if not _of_copies(holding[u])]
    cover = _cover([bag for bag, label in zip(bags, y) if label], likely, outside, n1, n0)
    if not cover:
        return None
    alike = similarities(likely, cover, self_kernel(cover)).max(1)
    strong = SHARE * evidence(likely[0])
    marks = [u for u, v in zip(likely, alike) if v >= FAMILY or evidence(u) >= strong or u in cover]
    # Look-alikes that stand out in clean texts are landmarks, too: else they could not be told from marks.
    decoys = sorted((u for u in outside if _evidence(outside[u], inside[u], n0, n1) >= EVIDENCE),
                    key=lambda u: (-_evidence(outside[u], inside[u], n0, n1), u))
    alike = similarities(decoys, cover, self_kernel(cover)).max(1)
    landmarks = _spread_out(marks)
    landmarks += [u for u, v in zip(decoys, alike) if v >= FAMILY]
    norms = self_kernel(landmarks)
    letters = Letters(landmarks)
    # Unit 0 is like no landmark: it stands for a text without units.
    vocabulary = ["", *sorted(set().union(*bags))]
    index = {u: i for i, u in enumerate(vocabulary)}
    members = [np.array([0, *(index[u] for u in bag)], int) for bag in bags]
    alike = np.zeros(len(vocabulary))
    for at in range(1, len(vocabulary), 20_000):
        part = vocabulary[at:at + 20_000]
        alike[at:at + len(part)] = similarities(part, landmarks, norms).max(1)
    clean = [i for i, u in enumerate(vocabulary) if outside[u] and harmless(u)]
    hard = sorted(clean, key=lambda i: (-alike[i], vocabulary[i]))[:HARD]
    between = similarities(landmarks, landmarks, norms)
    between = (between + between.T) / 2
    values, vectors = np.linalg.eigh(between)
    keep = values > 1e-3
    root = vectors[:, keep] / np.sqrt(values[keep])
    # Marks with any one character put in between are examples, too ("*" stands for it).
    inserted = [m[:i] + "*" + m[i:] for m in marks if len(m) > 6 for i in range(2, len(m) - 1)]
    altered = similarities(inserted, landmarks, norms) @ root

    # Multiple-instance rounds. First witnesses: the unit with most evidence, if any has some.
    marked = {index[u] for u in marks}
    value = np.array([evidence(u) if i in marked else 0.0 for i, u in enumerate(vocabulary)])
    for _ in range(ROUNDS):
        own = value.copy()
        own[clean] = min(0.0, value[0])  # no witness of a toxic text
        witnesses = sorted((marked | {
            int(m[own[m].argmax()]) for m, label in zip(members, y) if label and own[m].max() > 0
        }) - {0})
        hardest = {int(m[value[m].argmax()]) for m, label in zip(members, y) if not label}
        negatives = sorted((hardest | set(hard) | {0}) - set(witnesses))
        chosen = similarities([vocabulary[i] for i in witnesses + negatives], landmarks, norms) @ root
        x = np.concatenate((chosen, altered))
        x = np.column_stack([x, np.full(len(x), 0.5)])
        labels = np.array([1.0] * len(witnesses) + [-1.0] * len(negatives) + [1.0] * len(altered))
        # Look-alikes are many; a marked unit must not be given up for them.
        weight = COST * max(1.0, 3 * len(negatives) / len(witnesses))
        cost = np.where(labels > 0, weight, COST)
        cost[len(witnesses) + len(negatives):] = weight * len(marks) / max(1, len(altered))
        weights = _svm(x, labels, cost)
        # Every unit gets the value that scoring gives it.
        model = Model(letters, letters.folded(landmarks, root @ weights[:-1] / np.sqrt(norms)), float(weights[-1] / 2))
        value = model.values(vocabulary)
    # A mark needs no likeness to others: each is as sure as the surest, so that look-alikes of some cannot
    # place the curve above others.
    own = [index[u] for u in marks]
    sure = value[own].max()
    value[own] = sure
    # A unit too common in clean texts for an insult is harmless whatever it resembles. The curve is placed as
    # for texts not seen here: what a clean text alone tells of its units is left out.
    known = [i for i in clean if value[i] > value[0]]
    others = [i for i in known if _harmless(inside[vocabulary[i]], outside[vocabulary[i]] - 1, n1, n0)]
    unseen, raw = value.copy(), value.copy()
    unseen[others], value[known] = value[0], value[0]
    best = np.array([(value if label else unseen)[m].max() for m, label in zip(members, y)])
    # Disguised marks are as toxic as plain ones, though their values are lower: they place the curve, too.
    hidden = altered @ weights[:-1] + 0.5 * weights[-1]
    share = np.concatenate((np.ones(len(y)), np.full(len(hidden), ALTERED * n1 / max(1, len(hidden)))))
    slope, shift = _logistic(np.concatenate((best, hidden)), np.concatenate((y, np.ones(len(hidden)))), share)
    model = replace(model, slope=slope, shift=shift, marks=frozenset(marks), sure=float(sure))
    # Below a tenth of the threshold a harmless unit need not be remembered.
    telling = [vocabulary[i] for i in known if model.probability(raw[i]) >= THRESHOLD / 10]
    return replace(model, harmless=frozenset(telling))


class Scorer:
    """Scores of texts; remembers the values of units met before."""

    def __init__(self, model: Model):
        self.model = model
        self.plain: set[str] = set(model.harmless)
        self.known: dict[str, float] = {}

    def score(self, texts: list[str | None]) -> list[float]:
        bags = [units(t) if t else set() for t in texts]
        new = set()
        for bag in bags:
            new |= bag - self.plain
        new = sorted(u for u in new if u not in self.known)
        if new:
            parts = [(u, w) for u in new for w in windows(u)]
            values = self.model.values([w for _, w in parts])
            if len(self.plain) > CACHED_UNITS:
                self.plain = set(self.model.harmless)
            if len(self.known) > CACHED_UNITS:
                self.known = {}
            best = dict.fromkeys(new, self.model.bias)
            for (u, _), v in zip(parts, values.tolist()):
                best[u] = max(best[u], v)
            fresh = {u: v for u, v in best.items() if v > self.model.bias}
            self.known.update(fresh)
            self.plain.update(u for u in new if u not in fresh)
        out, bias = [], self.model.bias
        for bag in bags:
            near = bag - self.plain
            out.append(self.model.probability(max((self.known.get(u, bias) for u in near), default=bias)))
        return out


_scorers: dict[str, Scorer] = {}


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, clean: int = CLEAN) -> list:
    """At most ``sample`` toxic texts and ``clean`` others, chosen by a hash of the id."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    chosen = None
    for label, bound in ((1, sample), (0, clean)):
        own = marked.filter(F.col("toxic") == label).select("doc_id", "toxic").distinct()
        own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = own if chosen is None else chosen.unionByName(own)
    # ``chosen`` is two lists of bounded length; an id's repeated rows count once.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return texts.orderBy("doc_id", "toxic").collect()


def score(docs: DataFrame, model: Model | None, name: str, into: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with their score as column ``into``; one pass, no shuffle.

    ``name`` distinguishes models in long-lived Python workers.
    """
    if model is None:
        return docs.withColumn(into, F.lit(0.0))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _scorers.get(name)
        if own is None:
            _scorers.clear()
            own = _scorers[name] = Scorer(model)
        for texts in batches:
            values = texts.tolist()
            groups = (values[at:at + 500] for at in range(0, len(values), 500))
            yield pd.Series([x for group in groups for x in own.score(group)], dtype="float64")

    return docs.withColumn(into, scored("text"))


def learned(docs: DataFrame, labels: DataFrame, into: str = "score", sample: int = SAMPLE,
            clean: int = CLEAN) -> DataFrame:
    """``docs`` scored by a model fitted on labelled documents outside the held-out quarter."""
    rows = training_rows(docs, labels, sample, clean)
    model = fit([r["text"] for r in rows], [r["toxic"] for r in rows])
    return score(docs, model, uuid.uuid4().hex, into)


def predicted(score_column: str) -> Column:
    """1 where a score says that the text is toxic."""
    return (F.col(score_column) >= THRESHOLD).cast("int")
