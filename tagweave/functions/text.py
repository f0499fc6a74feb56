"""Column expressions for cleaning, tokenising and counting text.

Everything here is a built-in expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the markup that is deleted, in order of preference.
MATH_PATTERN = r"(\$\$.*?\$\$)|(\$.*?\$)|(\\begin.*?\\end\{.*?\})"

SPACE_PATTERN = r"\s+"
SENTENCE_PATTERN = r"[^.!?]+[.!?]*"
WORD_PATTERN = r"[\p{L}\p{N}]+"
WORD_OR_SYMBOL_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
LETTERS_PATTERN = r"[\p{L}]+"
NUMBERS_PATTERN = r"[\p{N}]+"
NON_LETTER_PATTERN = r"[^\p{L}]"


def strip_carriage_return(text: Column) -> Column:
    return F.regexp_replace(text, "\r", "")


def strip_math(text: Column, dotall: bool = False) -> Column:
    """Delete formulas; with ``dotall`` also those broken over several lines.

    A formula begins with one of two marks. A text without them is not matched,
    as the pattern is tried at every character.
    """
    stripped = F.regexp_replace(text, ("(?s)" if dotall else "") + MATH_PATTERN, "")
    return F.when(text.contains("$") | text.contains("\\begin"), stripped).otherwise(text)


def assemble_document(text: Column) -> Column:
    """One line of text: runs of white space become a blank, ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACE_PATTERN, " "))


def split_sentences(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def split_words(text: Column, keep_punct: bool = False) -> Column:
    pattern = WORD_OR_SYMBOL_PATTERN if keep_punct else WORD_PATTERN
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def normalize_tokens(tokens: Column, lower_case: bool = False) -> Column:
    """Keep the letters of each token, drop tokens that have none."""
    cased = (lambda t: F.lower(t)) if lower_case else (lambda t: t)
    letters = F.transform(tokens, lambda t: F.regexp_replace(cased(t), NON_LETTER_PATTERN, ""))
    return F.filter(letters, lambda t: t != "")


def split_normalized_words(text: Column, lower_case: bool = False) -> Column:
    """``normalize_tokens(split_words(text))`` in two scans of the text.

    Words are runs of letters and numbers, so deleting the numbers first and
    then taking the runs of letters yields the same tokens as cleaning each
    token on its own, without an interpreted lambda per token.
    """
    cased = F.lower(text) if lower_case else text
    letters_only = F.regexp_replace(cased, NUMBERS_PATTERN, "")
    return F.regexp_extract_all(letters_only, F.lit(LETTERS_PATTERN), 0)


def run_starts(sorted_items: Column) -> Column:
    """1-based positions at which a new value begins in a sorted array."""
    size = F.size(sorted_items)
    starts = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: (i == 1) | (F.element_at(sorted_items, i) != F.element_at(sorted_items, i - 1)),
    )
    return F.when(size > 0, starts).otherwise(F.array().cast("array<int>"))


def run_values(sorted_items: Column, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.element_at(sorted_items, i))


def run_counts(sorted_items: Column, starts: Column) -> Column:
    """Length of each run, from its start to the next one."""
    end = F.size(sorted_items) + 1
    return F.transform(starts, lambda i, k: F.coalesce(F.get(starts, k + 1), end) - i)
