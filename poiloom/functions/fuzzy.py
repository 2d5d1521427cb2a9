"""Similarity of names as sets of words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from poiloom.functions.text import BLANKS


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bits of a number standing for a's characters."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    every = (1 << len(a)) - 1
    open_ = every
    for ch in b:
        hit = open_ & at.get(ch, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & every
    return len(a) - open_.bit_count()


def token_set_similarity(a: str | None, b: str | None) -> float:
    """0 to 100: best of what the words in common and the words apart give; a subset of words gives 100."""
    left, right = set((a or "").split()), set((b or "").split())
    if not left or not right:
        return 0.0
    both, only_a, only_b = left & right, sorted(left - right), sorted(right - left)
    if both and (not only_a or not only_b):
        return 100.0
    text_a, text_b = " ".join(only_a), " ".join(only_b)
    na, nb, shared = len(text_a), len(text_b), len(" ".join(sorted(both)))
    gap = 1 if shared else 0
    full_a, full_b = shared + gap + na, shared + gap + nb

    def score(distance: int, length: int) -> float:
        return 100.0 - 100.0 * distance / length if length else 100.0

    best = score(na + nb - 2 * common_length(text_a, text_b), full_a + full_b)
    if shared:
        best = max(best, score(gap + na, shared + full_a), score(gap + nb, shared + full_b))
    return best


@F.pandas_udf(DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def name_words(name: str) -> Column:
    """The distinct words of a name."""
    return F.array_distinct(F.filter(F.split(F.coalesce(F.col(name), F.lit("")), BLANKS), lambda w: w != ""))


def score_bound(a: Column, b: Column) -> Column:
    """What the similarity of two names is at most, from the lengths of their words (name_words), without comparing letters."""

    def length(words: Column) -> Column:
        return F.length(F.array_join(words, " "))

    both = F.array_intersect(a, b)
    shared, na, nb = length(both), length(F.array_except(a, both)), length(F.array_except(b, both))
    gap = (shared > 0).cast("int")
    # at least the difference of their lengths has to be changed
    apart = 100.0 - 100.0 * F.abs(na - nb) / (2 * (shared + gap) + na + nb)
    with_shared = F.greatest(apart, 100.0 - 100.0 * (gap + na) / (2 * shared + gap + na), 100.0 - 100.0 * (gap + nb) / (2 * shared + gap + nb))
    bound = F.when(shared == 0, apart).when((na == 0) | (nb == 0), F.lit(100.0)).otherwise(with_shared)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(bound)
