"""Is a product title a match for a search query? Token coverage plus vetoes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Word lists of the veto rules. Pass your own dictionary to extend them.
WORDS: dict[str, list[str]] = {
    "stop": ["and", "for", "the", "with", "from"],
    "tool": ["cloth", "wipe", "brush", "brushe", "mop", "rag", "sponge"],
    "tool_query": ["cloth", "wipe", "brush", "brushe", "mop", "rag", "sponge", "microfiber"],
    "application": ["laundry", "dish", "dishe"],
    "bundle": ["promo", "bundle", "combo"],
    "surface": ["hardwood", "marble", "tile", "granite", "leather", "carpet"],
    "specialised": ["wax", "polish", "waterless"],
    "automotive": ["car", "vehicle", "auto", "automotive"],
}
THRESHOLD = 0.6


def tokens(text: Column, stop_words: list[str] = WORDS["stop"]) -> Column:
    """Distinct lower-cased words of three letters or more, plural 's' removed."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]{3,})"), F.lit(1))
    kept = F.filter(words, lambda w: ~w.isin(stop_words))
    return F.array_distinct(F.transform(kept, lambda w: F.regexp_replace(w, "([^s])s$", "$1")))


def _names(found: Column, words: list[str]) -> Column:
    return F.arrays_overlap(found, F.array(*[F.lit(w) for w in words]))


def _both(title: Column, query: Column, words: dict[str, list[str]]) -> Column:
    return F.struct(
        tokens(title, words["stop"]).alias("t"), tokens(query, words["stop"]).alias("q"),
        F.contains(title, F.lit("+")).alias("plus"),
    )


def _vetoed(pair: Column, words: dict[str, list[str]]) -> Column:
    t, q = pair["t"], pair["q"]

    def asked_but_missing(group: str) -> Column:
        asked = F.filter(q, lambda w: w.isin(words[group]))
        return F.size(F.array_except(asked, t)) > 0

    def named_but_not_asked(group: str) -> Column:
        named = F.filter(t, lambda w: w.isin(words[group]))
        return F.size(F.array_except(named, q)) > 0

    return (
        (_names(t, words["tool"]) & ~_names(q, words["tool_query"]))
        | named_but_not_asked("application")
        | pair["plus"]
        | _names(t, words["bundle"])
        | asked_but_missing("surface")
        | asked_but_missing("specialised")
        | (_names(q, words["automotive"]) & ~_names(t, words["automotive"]))
    )


def _covered(pair: Column) -> Column:
    shared = F.size(F.array_intersect(pair["q"], pair["t"]))
    return F.coalesce(F.try_divide(shared, F.size(pair["q"])), F.lit(0.0))


def vetoed(title: Column, query: Column, words: dict[str, list[str]] = WORDS) -> Column:
    """True when one of the six strictness rules rejects the title."""
    return let(_both(title, query, words), lambda p: _vetoed(p, words))


def coverage(title: Column, query: Column, words: dict[str, list[str]] = WORDS) -> Column:
    """Share of the query's words found in the title."""
    return let(_both(title, query, words), _covered)


def is_relevant(
    title: Column,
    query: Column,
    threshold: float = THRESHOLD,
    words: dict[str, list[str]] = WORDS,
) -> Column:
    """Unknown title or query counts as not relevant."""
    decision = let(
        _both(title, query, words),
        lambda p: (_covered(p) >= threshold) & ~_vetoed(p, words),
    )
    return F.coalesce(decision, F.lit(False))
