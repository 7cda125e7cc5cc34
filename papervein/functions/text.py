"""Column expressions over text: whitespace, sentences, tokens, offsets.

All of them stay inside the JVM.  Offsets count code points and ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every whitespace character, Unicode ones included.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# Alternatives are tried in order, so the order decides how codes split:
# "M300-35A" gives M300 - 35A, "50A470" stays whole, and a unit parts from its number
# however many digits that has: "45MPa" gives 45 MPa, "12W/kg" gives 12 W / kg.  Two digits
# and capitals are one token if a digit follows, as in a grade, or if the one capital ends
# the word and is no unit (T, W).
TOKEN = (
    r"W\d+(?:\.\d+)?/\d+k?"
    r"|(?:wt|mass)%"
    r"|\d{2}[A-Z]+\d[A-Za-z0-9]*"
    r"|\d{2}[A-SUVX-Z]\b"
    r"|\d+(?:\.\d+)?"
    r"|\p{L}[\p{L}\p{N}_]*"
    r"|\S"
)
# A token with the space behind it: the pieces of a sentence join back to the sentence.
PIECE = f"(?:{TOKEN}) ?"

# A sentence ends at . ! or ? before a space and an upper-case letter or a digit.
SENTENCE_BREAK = r"(?<=[.!?] )(?=[\p{Lu}\p{Nd}])"


def clean_whitespace(text: Column) -> Column:
    """Whitespace runs become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for NULL."""
    words = F.filter(F.split(text, WHITESPACE, -1), lambda word: word != "")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words)).cast("long")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def stem(filename: Column) -> Column:
    """The name without the extension of a paper or of its text, so that both meet."""
    return F.regexp_replace(filename, r"(?i)\.(pdf|txt)$", "")


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums, maxima or the like of an array, by doubling.

    Round r combines each value with the one 2^r places to the left, so an array of n values
    takes n log n steps, where appending to an accumulator would copy n^2 elements and fail
    on long documents.  ``combine`` must be associative and skip NULL, or get none.  Pass a
    plain column: the expression is used more than once.
    """
    rounds = F.sequence(
        F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")
    )
    return F.aggregate(
        rounds,
        values,
        lambda sums, r: F.transform(
            sums,
            lambda value, i: combine(value, F.get(sums, i - F.call_function("shiftleft", F.lit(1), r))),
        ),
    )


def running_starts(lengths: Column) -> Column:
    """Start position of each element of an array, given the elements' lengths (a plain column)."""
    ends = running(lengths, lambda total, before: total + F.coalesce(before, F.lit(0)))
    return F.zip_with(ends, lengths, lambda end, length: end - length)
