"""Lexicon sentiment and text length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentiment lexicon.
POSITIVE = ["good", "great", "excellent", "amazing", "awesome", "fantastic", "love", "best"]
NEGATIVE = ["bad", "terrible", "awful", "horrible", "poor", "disappointing", "worst", "hate"]


def sentiment(
    text: Column | str,
    positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE,
    mode: str = "substring",
) -> Column:
    """``(p - n) / (p + n)`` over the number of distinct lexicon words found, 0.0 when none is.

    ``substring`` finds a word anywhere in the lower-cased text ("whatever" holds "hate"); ``token`` wants
    whole words.
    """
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    if mode == "substring":
        def found(word: str) -> Column:
            return lowered.contains(word)
    elif mode == "token":
        tokens = F.split(lowered, r"[^\p{L}\p{N}]+")

        def found(word: str) -> Column:
            return F.array_contains(tokens, word)
    else:
        raise ValueError(f"unknown mode {mode!r}")

    def hits(words: Sequence[str]) -> Column:
        return reduce(add, [found(w.lower()).cast("int") for w in words], F.lit(0))

    p, n = hits(positive), hits(negative)
    return F.coalesce(F.try_divide((p - n).cast("double"), (p + n).cast("double")), F.lit(0.0))


def utf16_length(text: Column | str) -> Column:
    """Length in UTF-16 units: a character outside the basic plane counts twice."""
    text = F.col(text) if isinstance(text, str) else text
    return (F.length(F.encode(text, "UTF-16BE")) / 2).cast("int")
