"""Text checks on whole report texts, and the fixed wording of incident records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_to

# Characters read as a hyphen or a blank, number words, and phrase lists.
HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2212"
BLANKS = "\u00a0\u202f"
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
    "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17,
    "eighteen": 18, "nineteen": 19, "twenty": 20,
}
FAILED_TRUST_PHRASES = [
    "failed", "unreliable", "not trust", "should not be trusted", "cannot be trusted", "do not trust",
]
PASSED_TRUST_PHRASES = [
    "passed", "trustworthy", "data is valid", "data remain valid", "data remains valid",
    "data quality controls passed",
]
OVERCERTAIN_PHRASES = ["guaranteed", "proven with certainty", "100% certain", "definitively proven"]
REPORT_CONCEPTS = ["incident", "data", "root cause", "business impact", "recommended", "confidence"]
FAILED_TRUST_WORDS = ["failed", "not trust", "unreliable"]
PASSED_TRUST_WORDS = ["passed", "trustworthy", "valid"]


def plain_dashes(text: Column | str) -> Column:
    """Typographic dashes to ``-`` and no-break blanks to a blank."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(text, HYPHENS + BLANKS, "-" * len(HYPHENS) + " " * len(BLANKS))


def mentions(text: Column, phrase: Column | str) -> Column:
    return F.contains(text, F.lit(phrase) if isinstance(phrase, str) else phrase)


def mentions_any(text: Column, phrases: list[str]) -> Column:
    found = mentions(text, phrases[0])
    for phrase in phrases[1:]:
        found = found | mentions(text, phrase)
    return found


def phrases_found(text: Column, phrases: list[str], found: bool = True) -> Column:
    """The listed phrases that occur in the text (or, with ``found=False``, that do not)."""
    hits = [F.when(mentions(text, p) if found else ~mentions(text, p), F.lit(p)) for p in phrases]
    return F.array_compact(F.array(*hits))


def stated_durations(text: Column) -> Column:
    """Day counts in phrases such as "7-day window" or "seven day period", as digit strings.

    Counts written in digits come first, then those written as words, each in text order. The
    digits stay text, so a count of any length is read whole.
    """
    digits = F.regexp_extract_all(text, F.lit(r"(?U)\b([0-9]+)[-\s]?days?\s+(?:window|period)\b"), F.lit(1))
    words = F.regexp_extract_all(
        text, F.lit(r"(?U)\b(" + "|".join(NUMBER_WORDS) + r")[-\s]day\s+(?:window|period)\b"), F.lit(1)
    )
    numbers = F.create_map(*[F.lit(x) for word, n in NUMBER_WORDS.items() for x in (word, str(n))])
    return F.concat(
        F.transform(digits, lambda d: F.regexp_replace(d, "^0+(?=.)", "")),
        F.transform(words, lambda w: numbers[w]),
    )


def split_list(text: Column | str) -> Column:
    """Parts of a ``|``-separated text, trimmed, without empty parts; empty for NULL."""
    parts = F.transform(F.split(text, r"\|"), lambda part: F.trim(part))
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))


def join_list(items: Column | str) -> Column:
    return F.array_join(items, " | ")


def number(value: Column | str, places: int = 2, signed: bool = False) -> Column:
    """A number with a fixed count of decimals, rounded as everywhere else; 'n/a' for NULL."""
    rounded = round_to(value, places)
    text = F.format_string(f"%{'+' if signed else ''}.{places}f", rounded)
    return F.when(rounded.isNotNull(), text).otherwise("n/a")


def place(city: Column | str, country: Column | str) -> Column:
    return F.concat_ws(", ", city, country)
