"""Heads of misspelled words, by counts over all data and an equi-join on deletion neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deletions(word: Column) -> Column:
    """The word and all it becomes with one letter left out: two words one edit apart (a letter
    exchanged, added, left out or two neighbours swapped) have one of these in common."""
    without = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), without))


def heads(words: DataFrame, group: str, least_letters: int = 4, times: float = 4.0) -> DataFrame:
    """(group, word, head, n): the spellings of the same group one edit from word and times as frequent.

    words: group, word, n. Words of fewer letters, or with digits, have no heads and are none.
    Every candidate is kept, with its count; the caller chooses.
    """
    fit = words.where((F.length("word") >= least_letters) & ~F.col("word").rlike(r"\d") & (F.length("word") <= 64))
    k = fit.withColumn("k", F.explode(deletions(F.col("word"))))
    big = k.where(f"n >= {times}").select(group, "k", F.col("word").alias("head"), F.col("n").alias("hn"))
    j = k.join(big, [group, "k"]).where((F.col("word") != F.col("head")) & (F.col("hn") >= times * F.col("n")))
    # one letter left out on each side may still be two edits apart, if not at the same place
    same = F.length("word") == F.length("head")
    near = (F.levenshtein("word", "head") <= F.when(same, 2).otherwise(1)) & (~same | (F.levenshtein("word", "head") == 1) | (F.array_sort(F.split("word", "")) == F.array_sort(F.split("head", ""))))
    return j.where(near).groupBy(group, "word", "head").agg(F.max("hn").alias("n"))
