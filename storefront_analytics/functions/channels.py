"""Marketing-channel names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw traffic source -> reported channel.
CHANNEL_BY_SOURCE = {
    "search": "Search",
    "adwords": "Search",
    "display": "Display",
    "youtube": "Display",
    "facebook": "Facebook",
    "email": "Email",
    "organic": "Organic",
}
UNKNOWN_CHANNEL = "Unknown"

# Besides the blank, characters after which a new word starts.
WORD_DELIMITERS = r"""[\t\n\r!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""
_WORD_MARK = "\u0001 "


def title_words(text: Column) -> Column:
    """First letter of every word upper case, the rest lower case.

    ``initcap`` starts words after blanks only, so a marked blank is put after
    each punctuation character and taken out again: ``paid-social`` becomes
    ``Paid-Social``. All of it stays inside generated code.
    """
    marked = F.regexp_replace(text, f"({WORD_DELIMITERS})", f"$1{_WORD_MARK}")
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def canonical_channel(source: Column) -> Column:
    """Reported channel of a raw traffic source; a missing source is Unknown."""
    name = F.trim(source)
    channel = F.when(source.isNull(), F.lit(UNKNOWN_CHANNEL))
    for raw, reported in CHANNEL_BY_SOURCE.items():
        channel = channel.when(F.lower(name) == raw, F.lit(reported))
    return channel.otherwise(title_words(name))
