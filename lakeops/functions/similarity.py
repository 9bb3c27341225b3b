"""Token-set similarity of two texts, 0 to 100.

Both texts are folded to lower-case word tokens. With I the sorted common tokens, and A and B
being I followed by the sorted rest of either side, the score is the best of the three pairwise
ratios, where a ratio is 100 * 2 * LCS / (both lengths). An empty side scores 0; NULL stays NULL.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import IntegerType

_NON_WORD = re.compile(r"\W")
# The characters U+0080 to U+00FF are removed before tokens are cut, as the scorer whose numbers these
# must equal does, so "café" and "caf" are one token; later letters such as "ą" stay.
_DROPPED = {code: None for code in range(128, 256)}


def longest_common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; one big-integer step per character of ``b``."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        match = open_bits & positions.get(ch, 0)
        open_bits = ((open_bits + match) | (open_bits - match)) & full
    return len(a) - open_bits.bit_count()


def _ratio(shared: int, lengths: int) -> int:
    return round(100 * 2 * shared / lengths)


def token_set_score(left: str | None, right: str | None) -> int | None:
    if left is None or right is None:
        return None
    one, two = (set(_NON_WORD.sub(" ", s.translate(_DROPPED)).lower().split()) for s in (left, right))
    if not one or not two:
        return 0
    common = " ".join(sorted(one & two))
    rests = [" ".join(sorted(rest)) for rest in (one - two, two - one)]
    if common and not all(rests):
        return 100
    # I begins both A and B, so it is shared whole; only the rests need the longest subsequence.
    start = f"{common} " if common else ""
    lengths = [len(start) + len(rest) for rest in rests]
    scores = [_ratio(len(start) + longest_common_subsequence(*rests), sum(lengths))]
    if common:
        scores += [_ratio(len(common), len(common) + length) for length in lengths]
    return max(scores)


@F.pandas_udf(IntegerType())
def token_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """The score for two string columns, in Arrow batches.

    A pair costs length times length / 64 steps, in one call of a worker: well under a second for texts of 20,000
    words, but growing with the square.
    """
    return pd.Series([token_set_score(a, b) for a, b in zip(left, right)], dtype="Int32")


def token_similarity_native(left: Column, right: Column) -> Column:
    """A different score without a Python worker: 100 * (1 - edit distance / longer length)."""
    def tokens(text: Column) -> Column:
        words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
        return F.array_distinct(F.filter(words, lambda w: w != ""))

    def ratio(a: Column, b: Column) -> Column:
        longer = F.greatest(F.length(a), F.length(b))
        return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(
            F.round(F.lit(100.0) * (longer - F.levenshtein(a, b)) / longer).cast("int"))

    one, two = tokens(left), tokens(right)
    common = F.array_join(F.array_sort(F.array_intersect(one, two)), " ")
    full_one = F.trim(F.concat_ws(" ", common, F.array_join(F.array_sort(F.array_except(one, two)), " ")))
    full_two = F.trim(F.concat_ws(" ", common, F.array_join(F.array_sort(F.array_except(two, one)), " ")))
    return F.greatest(ratio(common, full_one), ratio(common, full_two), ratio(full_one, full_two))
