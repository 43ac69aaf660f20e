"""Licence scan by a positional index of rare words.

Each licence template is a short text; its words and their places are the postings. Words
are weighted by their inverse document frequency over all documents. The heaviest word of
a template's mandatory phrase is its anchor: where a file has it, its place less the
anchor's place in the template is where the template would begin. There the template's
other words are looked up at their relative places; the template is found if the words in
place carry at least ``COVERED`` of its weight and its mandatory phrase stands complete
there. A match has the phrase, so no start is missed; the SQL below starts from the
``KEYS`` heaviest words of a template only. Phrases of the base list are found on their own, word by word.

Everything is DataFrame expressions. One pass over the texts keeps, of each row, the
number of words and the places of the few words that templates and phrases contain; a
second pass over that narrow table does the rest within each row. Nothing is shuffled but
the counts of those words.

A null text is empty: no words, no labels. Texts of any length are read whole; a phrase that stands more
than once counts each time; repeated rows give repeated results; a null id is
passed through; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KEYS = 2
COVERED = 0.8

#: Base phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, template, mandatory phrase; punctuation is not part of words.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3.0", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mit-release", "released under the mit license", "under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "for any purpose with or without fee"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
]

_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vocabulary() -> list[str]:
    texts = [*PHRASES, *(t for _, t, _ in TEMPLATES), *(m for _, _, m in TEMPLATES)]
    return sorted({w for t in texts for w in t.split()})


def _places(text: Column) -> list[Column]:
    """Number of words, and (pos, w) of those in the vocabulary, lower-cased."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")
    known = vocabulary()

    def place(w, i):
        mine = F.lower(w).isin(known) & (F.octet_length(w) == F.char_length(w))
        return F.when(mine, F.struct(i.alias("pos"), F.lower(w).alias("w")))

    return [F.size(words).cast("bigint").alias("n_words"),
            F.array_compact(F.transform(words, place)).alias("hits")]


def _at(hits: Column, pos: Column, word: str) -> Column:
    return F.array_contains(hits, F.struct(pos.cast("int").alias("pos"), F.lit(word).alias("w")))


def _stands(hits: Column, begin: Column, phrase: str) -> Column:
    """Whether a phrase's words stand one after the other from ``begin``."""
    all_there = F.lit(True)
    for n, word in enumerate(phrase.split()):
        all_there = all_there & _at(hits, begin + n, word)
    return all_there


def _starts(hits: Column, phrase: str) -> Column:
    """Starts of a phrase."""
    first = phrase.split()[0]
    found = F.filter(hits, lambda h: (h["w"] == first) & _stands(hits, h["pos"], phrase))
    return F.transform(found, lambda h: h["pos"].cast("bigint"))


def _anchor(mandatory: str, weight: dict[str, float]) -> str:
    """The heaviest word of a mandatory phrase: a match has it, so its places give every start."""
    return min(mandatory.split(), key=lambda w: (-weight[w], w))


def _coverage(hits: Column, template: str, mandatory: str, weight: dict[str, float]) -> Column:
    """Largest share of the template's weight in place, of all places where the phrase stands."""
    words = template.split()
    total = sum(weight[w] for w in words)
    shift = _offset(words, mandatory.split())
    anchor = _anchor(mandatory, weight)
    place = shift + mandatory.split().index(anchor)

    def covered(begin):
        there = sum(
            (F.when(_at(hits, begin + n, w), F.lit(weight[w])).otherwise(F.lit(0.0)) for n, w in enumerate(words)),
            F.lit(0.0),
        )
        return F.when(_stands(hits, begin + shift, mandatory), there / F.lit(total))

    begins = F.transform(F.filter(hits, lambda h: h["w"] == anchor), lambda h: h["pos"] - place)
    return F.coalesce(F.array_max(F.transform(begins, covered)), F.lit(0.0))


def _offset(words: list[str], part: list[str]) -> int:
    """Where a template's mandatory phrase begins in it."""
    return next(i for i in range(len(words)) if words[i:i + len(part)] == part)


def weights(places: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every vocabulary word, over all rows."""
    rows = places.count()
    counts = places.select(F.explode(F.array_distinct(F.col("hits.w"))).alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in counts.collect()}  # one row per vocabulary word at most
    return {w: math.log((rows + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in vocabulary()}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, per row."""
    places = written(docs.select("doc_id", *_places(F.col("text"))), "licence-words")
    weight = weights(places)
    hits = F.col("hits")
    rare = sorted(
        {w for p in PHRASES for w in p.split()[:1]}
        | {_anchor(m, weight) for _, _, m in TEMPLATES}
    )
    # Rows without any anchor or first word of a phrase have nothing to look up.
    likely = F.exists(hits, lambda h: h["w"].isin(rare))
    base = {label: _starts(hits, phrase) for phrase, label in PHRASES.items()}
    none = F.array().cast("array<bigint>")
    found = places.select("doc_id", "n_words", *[
        F.when(likely, starts).otherwise(none).alias(f"b{i}") for i, starts in enumerate(base.values())
    ], *[
        F.when(likely, _coverage(hits, t, m, weight)).otherwise(F.lit(0.0)).alias(f"t{i}")
        for i, (_, t, m) in enumerate(TEMPLATES)
    ])
    starts = F.concat(*[F.col(f"b{i}") for i in range(len(base))])
    own = [F.when(F.size(f"b{i}") > 0, F.lit(label)) for i, label in enumerate(base)]
    more = [F.when(F.col(f"t{i}") >= COVERED, F.lit(label)) for i, (label, _, _) in enumerate(TEMPLATES)]
    best = F.greatest(*[F.when(F.col(f"t{i}") >= COVERED, F.col(f"t{i}")).otherwise(F.lit(0.0))
                        for i in range(len(TEMPLATES))])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    return found.select(
        "doc_id", "n_words",
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(own).alias("base_labels"), joined(own + more).alias("labels"),
        F.round(F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))), 6).alias("score"),
    )


def oracle_sql() -> str:
    """The same result in DuckDB SQL, by joins instead of expressions within rows."""
    def values(rows):
        return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)

    phrase_words = values((p, label, i, w) for p, label in PHRASES.items() for i, w in enumerate(p.split()))
    template_words = values((label, i, w) for label, t, _ in TEMPLATES for i, w in enumerate(t.split()))
    needed = values(
        (label, _offset(t.split(), m.split()) + i, w)
        for label, t, m in TEMPLATES for i, w in enumerate(m.split())
    )
    return f"""
WITH phrases(phrase, label, place, w) AS (VALUES {phrase_words}),
templates(label, place, w) AS (VALUES {template_words}),
needed(label, place, w) AS (VALUES {needed}),
numbered AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
    FROM documents
),
known AS (SELECT w FROM phrases UNION SELECT w FROM templates UNION SELECT w FROM needed),
placed AS (
    SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos FROM numbered
),
hits AS (SELECT * FROM placed WHERE w IN (SELECT w FROM known)),
idf AS (
    SELECT w, ln(((SELECT count(*) FROM numbered) + 1) / (count(DISTINCT r) + 1)) + 1e-9 AS weight
    FROM known LEFT JOIN hits USING (w) GROUP BY w
),
based AS (
    SELECT r, label, h.pos - p.place AS start FROM hits h JOIN phrases p USING (w)
    GROUP BY r, label, phrase, start
    HAVING count(*) = (SELECT count(*) FROM phrases q WHERE q.phrase = p.phrase)
),
keyed AS (
    SELECT label, w FROM (SELECT DISTINCT label, w, weight FROM templates JOIN idf USING (w))
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY weight DESC, w) <= {KEYS}
),
begins AS (
    SELECT DISTINCT r, label, h.pos - t.place AS start
    FROM hits h JOIN templates t USING (w) JOIN keyed USING (label, w)
),
covered AS (
    SELECT b.r, b.label, b.start, sum(weight) AS got
    FROM begins b JOIN templates t USING (label)
    JOIN hits h ON h.r = b.r AND h.w = t.w AND h.pos = b.start + t.place JOIN idf ON idf.w = t.w
    GROUP BY ALL
),
complete AS (
    SELECT b.r, b.label, b.start FROM begins b JOIN needed n USING (label)
    JOIN hits h ON h.r = b.r AND h.w = n.w AND h.pos = b.start + n.place
    GROUP BY b.r, b.label, b.start
    HAVING count(*) = (SELECT count(*) FROM needed m WHERE m.label = b.label)
),
matched AS (
    SELECT c.r, c.label, max(c.got / total) AS share
    FROM covered c JOIN complete USING (r, label, start)
    JOIN (SELECT label, sum(weight) AS total FROM templates JOIN idf USING (w) GROUP BY label) USING (label)
    GROUP BY ALL HAVING share >= {COVERED}
),
base AS (
    SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM based GROUP BY r
),
every AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS best
    FROM (SELECT r, label, 0 AS share FROM based UNION ALL SELECT r, label, share FROM matched) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    round(CASE WHEN n_base > 0 THEN 1 ELSE least(coalesce(best, 0), 1) END, 6)::DOUBLE AS score
FROM numbered LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""
