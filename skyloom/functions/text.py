"""English analyzer: tokens, stop words, plural stemming."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# English stop words, fixed values.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)

# Separator between tokens, fixed value.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_tokens(text: Column | str) -> Column:
    """Lower-case tokens, stop words still included."""
    return F.split(F.lower(_col(text)), TOKEN_SEPARATOR)


def is_term(token: Column) -> Column:
    return (token != "") & ~token.isin(*STOP_WORDS)


def stem(token: Column | str) -> Column:
    """Plural stemmer: ``-ies`` to ``-y``, otherwise a final ``s`` goes, with the usual exceptions.

    ``-us``, ``-ss``, ``-aies``, ``-eies``, ``-aes``, ``-ees``, ``-oes`` and words below three letters stay.
    """
    token = _col(token)
    n = F.length(token)
    stays = ~token.endswith("s") | (n < 3)
    for ending in ("us", "ss", "aies", "eies", "aes", "ees", "oes"):
        stays = stays | token.endswith(ending)
    ies = token.endswith("ies")
    return (
        F.when(stays | (ies & (n == 3)), token)
        .when(ies, F.concat(F.substring(token, F.lit(1), n - 3), F.lit("y")))
        .otherwise(F.substring(token, F.lit(1), n - 1))
    )


def analyze_english(text: Column | str) -> Column:
    """Text to its array of terms, in text order, repeats kept."""
    return F.transform(F.filter(raw_tokens(text), is_term), stem)
