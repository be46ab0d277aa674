"""Token counting."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import PUNCTUATION, STOP_WORDS, clean_word, is_kept, lines_to_words


def tokenize(df: DataFrame, column: str = "value", output: str = "word") -> DataFrame:
    """One row per piece of text between single spaces, next to the other columns."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, F.explode(lines_to_words(F.col(column))).alias(output))


def word_count(
    df: DataFrame,
    column: str = "value",
    k: int | None = None,
    punctuation: str = PUNCTUATION,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Occurrences of each cleaned word; with ``k`` the most frequent ones only.

    Words are stripped first and tested against the stop words after, in their
    own case. Counts are combined before the shuffle, so a word that makes up a
    large share of the text still reaches its reducer as one row per task.
    """
    words = tokenize(df.select(column), column).select(
        clean_word(F.col("word"), punctuation).alias("word")
    )
    counts = (
        words.filter(is_kept(F.col("word"), stop_words))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if k is None:
        return counts
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)
