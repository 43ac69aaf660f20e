"""Language identification in two steps: family first, then pairs of close languages.

Features are relative frequencies of hashed byte bigrams and trigrams of the
lower-cased text. A linear model per family decides which family a text belongs to; within
it, a linear support vector machine for every pair of its languages votes, and the language
with most votes wins, ties going to the larger sum of margins. ``FAMILIES`` assigns
languages to families; a language it lacks is a family of its own. The values of ``lang``
that training rows have are the languages that can be predicted.

The machines are trained on a bounded sample (``SAMPLE`` rows of each language, by hash);
predicting reads every whole text once, without a shuffle. As a linear score of mean
frequencies is the mean of its weights over the text, a batch is scored by looking up
weights and summing them per text. The model is a few megabytes.

A null text, or one without a letter, is ``und`` with score 0. Texts of any length are
read whole; repeated rows give repeated results; training rows with a null language or
id are not used; with none at all every text is ``und``; an empty table gives an empty
table; further columns do no harm.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 700
BITS = 14
BUCKETS = 1 << BITS
ROUNDS = 60
COST = 50.0
BIAS = 0.01
UNDETERMINED = "und"

#: Language families of common languages (fixed values, ISO 639-1 codes).
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
    "semitic": ("ar", "he"),
    "indo-aryan": ("hi", "bn", "ur", "mr"),
    "sinitic": ("zh",),
}

_LETTER = re.compile(r"[^\W\d_]")


def family(language: str) -> str:
    return next((f for f, own in FAMILIES.items() if language in own), language)


def _grams(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigrams and trigrams that begin at each byte."""
    b = joined.astype(np.uint32)
    two = b[:-2] | b[1:-1] << 8
    three = two | b[2:] << 16
    mixed = [(x * np.uint32(m)) >> np.uint32(32 - BITS) for x, m in ((two, 2654435761), (three, 2246822519))]
    return mixed[0], mixed[1]


def _prepared(text: str) -> bytes:
    """Words between single spaces, in lower case, with two more spaces so grams never cross texts."""
    return (" " + " ".join(text.lower().split()) + "  ").encode("utf-8", "surrogatepass")


def features(texts: list[str]) -> np.ndarray:
    """Relative gram frequencies, one row a text; for training."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        two, three = _grams(np.frombuffer(_prepared(text), np.uint8))
        counts = np.bincount(two, minlength=BUCKETS) + np.bincount(three, minlength=BUCKETS)
        out[i] = counts / max(1, 2 * len(two))
    return out


def sums(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """``features(texts) @ weights``, by lookups."""
    encoded = [_prepared(t) for t in texts]
    lengths = np.array([len(e) for e in encoded])
    two, three = _grams(np.frombuffer(b"".join(encoded), np.uint8))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    out = np.empty((len(texts), weights.shape[1]))
    for k in range(weights.shape[1]):
        values = weights[:, k][two] + weights[:, k][three]
        total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64), [0.0]))
        total[-1] = total[-2]
        # The last two places of a text begin grams of the next one.
        out[:, k] = (total[starts + lengths - 2] - total[starts]) / np.maximum(1, 2 * (lengths - 2))
    return out


def _svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear SVM on some rows of ``x`` by dual coordinate descent; the last weight is the bias."""
    weights, alpha = np.zeros(x.shape[1] + 1, np.float32), np.zeros(len(y))
    square = np.array([x[r] @ x[r] for r in rows]) + BIAS**2
    cost = COST / np.where(y > 0, (y > 0).mean(), (y < 0).mean()) / square.mean()
    order = np.random.default_rng(0)
    for _ in range(ROUNDS):
        changed = 0.0
        for i in order.permutation(len(y)):
            row = x[rows[i]]
            margin = y[i] * (float(row @ weights[:-1]) + BIAS * float(weights[-1]))
            new = min(max(alpha[i] - (margin - 1) / square[i], 0.0), cost[i])
            if abs(new - alpha[i]) > 1e-9:
                step = np.float32((new - alpha[i]) * y[i])
                weights[:-1] += step * row
                weights[-1] += step * BIAS
                changed = max(changed, abs(new - alpha[i]) * square[i])
                alpha[i] = new
        if changed < 1e-3:
            break
    weights[-1] *= BIAS
    return weights


@dataclass(frozen=True)
class Model:
    """Columns of ``weights``: one per family (one against the rest), then one per pair."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [i for i, t in enumerate(texts) if t and self.families and _LETTER.search(t)]
        languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not found:
            return languages, scores
        margins = sums([texts[i] for i in found], self.weights) + self.bias
        for i, row in zip(found, margins):
            own = self.families[int(row[:len(self.families)].argmax())]
            certainty = [_sure(np.sort(row[:len(self.families)])[::-1])]
            votes = {m: [0, 0.0] for m in self.members[own]}
            for (a, b), margin in zip(self.pairs, row[len(self.families):]):
                if a in votes and b in votes:
                    votes[a if margin > 0 else b][0] += 1
                    votes[a][1] += margin
                    votes[b][1] -= margin
            best = min(votes, key=lambda m: (-votes[m][0], -votes[m][1], m))
            certainty += [
                1 / (1 + np.exp(-2 * (margin if a == best else -margin)))
                for (a, b), margin in zip(self.pairs, row[len(self.families):])
                if best in (a, b)
            ]
            languages[i], scores[i] = best, float(min(certainty))
        return languages, scores


def _sure(margins: np.ndarray) -> float:
    """Certainty of the best of several machines: 1 if there is only one."""
    return 1.0 if len(margins) < 2 else float(1 / (1 + np.exp(-(margins[0] - margins[1]))))


def fit(texts: list[str], languages: list[str]) -> Model:
    usable = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    texts, languages = [texts[i] for i in usable], np.array([languages[i] for i in usable], object)
    known = sorted(set(languages))
    members: dict[str, list[str]] = {}
    for language in known:
        members.setdefault(family(language), []).append(language)
    families = sorted(members)
    if not families:
        return Model([], {}, [], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    x = features(texts)
    kin = np.array([family(language) for language in languages], object)
    columns, pairs = [], []
    for name in families:
        if len(families) == 1:
            columns.append(np.zeros(BUCKETS + 1, np.float32))
        elif len(families) == 2 and columns:
            columns.append(-columns[0])
        else:
            columns.append(_svm(x, np.arange(len(x)), np.where(kin == name, 1.0, -1.0)))
    for name in families:
        for a, b in combinations(members[name], 2):
            own = np.flatnonzero((languages == a) | (languages == b))
            pairs.append((a, b))
            columns.append(_svm(x, own, np.where(languages[own] == a, 1.0, -1.0)))
    weights = np.stack(columns, 1)
    return Model(families, members, pairs, np.asfortranarray(weights[:-1]), weights[-1].astype(float))


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> list:
    """``sample`` rows of every language outside the held-out quarter, or all: those of least hash of the id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.pmod(crc, F.lit(4)) != 2)
    ).distinct()
    counts = marked.groupBy("lang").count()
    # A share of each language's ids, twice what is wanted; the number of languages is small. Hashes
    # are even, so the window sorts about that many rows a language however large it is.
    share = counts.select("lang", (F.lit(2.0 * sample + 100) / F.col("count")).alias("_share"))
    chosen = (
        marked.withColumn("_hash", F.xxhash64("doc_id", "lang"))
        .join(F.broadcast(share), "lang")
        .filter(F.col("_hash") / 2.0**64 + 0.5 < F.col("_share"))
        .withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "doc_id")))
        .filter(F.col("_n") <= sample)
        .select("doc_id", "lang")
    )
    # At most ``sample`` ids for each language.
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    return (
        rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
        .orderBy("lang", "doc_id").collect()
    )


_models: dict[str, Model] = {}
PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def predicted(model_name: str, broadcast):
    """A vectorised function: text to language and score."""

    def predict(texts: pd.Series) -> pd.DataFrame:
        if model_name not in _models:
            _models.clear()
            _models[model_name] = broadcast.value
        model, values = _models[model_name], texts.tolist()
        languages, scores = [], []
        for at in range(0, len(values), 200):
            a, b = model.predict(values[at:at + 200])
            languages += a
            scores += b
        return pd.DataFrame({"lang_pred": languages, "score": scores})

    return F.pandas_udf(predict, PREDICTION)


def identify(docs: DataFrame, into: str = "prediction", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a struct column ``into`` of ``lang_pred`` and ``score``."""
    rows = training_rows(docs, sample)
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows])
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(into, predicted(uuid.uuid4().hex, broadcast)("text"))
