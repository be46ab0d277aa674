"""Word cleaning."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a word, and the words
# left out of the counts.
PUNCTUATION = "\"'`,:.![]<>-"
STOP_WORDS = (
    "", "a", "an", "the", "this", "to", "for", "and", "##", "can", "on", "is", "in", "of", "also",
    "if", "with", "you", "or",
)

# What ends a line, the longest first.
_LINE_ENDS = ("\r\n", "\n", "\r")


def lines_to_words(text: Column) -> Column:
    """Pieces between single spaces of every line; empty pieces are kept.

    A line end separates just as one space does. Putting spaces first lets the
    split run on a single character instead of a pattern.
    """
    for end in _LINE_ENDS:
        text = F.replace(text, F.lit(end), F.lit(" "))
    return F.split(text, " ")


def clean_word(word: Column, punctuation: str = PUNCTUATION) -> Column:
    return F.btrim(word, F.lit(punctuation))


def is_kept(word: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return ~word.isin(*stop_words)
