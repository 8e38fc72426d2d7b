"""Text-analysis chains as array-of-string columns; all built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfweave.functions.scalars import fold_accents

_STRINGS = "array<string>"


def _cut(c: Column, separators: str) -> Column:
    return F.filter(F.split(c, separators), lambda t: t != "")


def word_tokens(c: Column) -> Column:
    """Runs of letters and digits."""
    return _cut(c, r"[^\p{L}\p{N}]+")


def blank_tokens(c: Column) -> Column:
    """Runs of non-blank characters."""
    return _cut(c, r"\s+")


def without(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Tokens that are no stop words; repeats stay."""
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def standard(c: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case word tokens without stop words."""
    return without(word_tokens(F.lower(c)), stop_words)


def shingles(tokens: Column, smallest: int = 2, largest: int = 3) -> Column:
    """All single tokens, then the runs of ``smallest`` to ``largest`` neighbouring tokens.

    Give it a materialised column: the list is read once per place in a run.
    """
    parts = [tokens]
    for size in range(smallest, largest + 1):
        count = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
        run = F.slice(tokens, 1, count)
        for place in range(2, size + 1):
            run = F.zip_with(run, F.slice(tokens, place, count), lambda left, right: F.concat_ws(" ", left, right))
        parts.append(run)
    return F.concat(*parts)


def reversed_words(c: Column) -> Column:
    """Word tokens read backwards, case kept."""
    return F.transform(word_tokens(c), lambda t: F.reverse(t))


def edge_grams(c: Column, shortest: int = 2, longest: int = 10) -> Column:
    """Lower-case prefixes of ``shortest`` to ``longest`` characters of runs of letters, digits and punctuation."""
    tokens = F.filter(_cut(F.lower(c), r"[^\p{L}\p{Nd}\p{P}]+"), lambda t: F.length(t) >= shortest)
    return F.flatten(
        F.transform(
            tokens,
            lambda t: F.transform(
                F.sequence(F.lit(shortest), F.least(F.lit(longest), F.length(t))), lambda i: F.substring(t, F.lit(1), i)
            ),
        )
    )


def letter_tokens(c: Column) -> Column:
    """Lower-case runs of letters."""
    return _cut(F.lower(c), r"[^\p{L}]+")


def folded(tokens: Column) -> Column:
    """Tokens without accents."""
    return F.transform(tokens, fold_accents)
