"""Text predicates and clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from basketry.schemas import NA_TOKENS


def present(text: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """The text, or NULL where it is one of the missing-value tokens."""
    return F.when(~text.isin(*tokens), text)


def strip_prefix(text: Column, prefix: str) -> Column:
    """Remove every occurrence of a literal (``d_12`` to ``12``)."""
    return F.replace(text, F.lit(prefix), F.lit(""))


def long_enough(text: Column, at_least: int) -> Column:
    """Length in code points is at least ``at_least``; NULL text fails."""
    return F.length(text) >= F.lit(at_least)


def mentions_or_missing(text: Column, word: str) -> Column:
    """The text is NULL, or holds ``word`` in any letter case."""
    return text.isNull() | F.contains(F.lower(text), F.lit(word.lower()))
