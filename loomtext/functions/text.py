"""Scalar text functions: Column -> Column, native unless a function's docstring says otherwise."""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words (the Unicode white space that str.split() knows), for use inside a regex class.
SPACE = "\t-\r\x1c-\x20\x85\xa0  -     　"
#: What ends a line.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
#: Characters that count as digits beside the decimal ones.
_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"


@F.pandas_udf(T.StringType())  # a type, not a name: workers import this module without a session
def normalized(text: pd.Series) -> pd.Series:
    """NFKC, case folding and single blanks: the identity of a text. Arrow UDF: Spark has neither NFKC nor case folding."""
    fold = lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split())
    return pd.Series([fold(t) for t in text], dtype=object)


@F.pandas_udf(T.StringType())
def lowered(text: pd.Series) -> pd.Series:
    """Lower case character by character, as DuckDB's lower() has it: two capitals are else more than one character, or depend on their place."""
    return pd.Series([None if t is None else t.replace("İ", "i").replace("Σ", "σ").lower() for t in text], dtype=object)


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def identity_hash(text: Column) -> Column:
    """SHA-256 of the normalized text."""
    return text_hash(normalized(text))


def collapse(text: Column) -> Column:
    """Single blanks for white space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0))


def is_blank(text: Column) -> Column:
    return text.isNull() | (word_count(text) == 0)


def length_bucket(words: Column) -> Column:
    return F.when(words < 50, "under_50_words").when(words < 200, "50_to_199_words").otherwise("200_plus_words")


def strip_markers(text: Column, tag: str = "v") -> Column:
    """Removes the annotation wrapper <tag>...</tag> and keeps what it wraps."""
    return F.regexp_replace(text, f"</?{tag}>", "")


def lines_of(text: Column) -> Column:
    """Lines without their ends; a final line end opens no further line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def tail_lines(text: Column, lines: int = 14, shortest: int = 3, longest: int = 210) -> Column:
    """The distinct collapsed lines among the last ones, of usual length."""
    parts = lines_of(text)
    last = F.slice(parts, F.greatest(F.lit(1), F.size(parts) - (lines - 1)), F.lit(lines))
    clean = F.transform(last, collapse)
    return F.array_distinct(F.filter(clean, lambda x: F.length(x).between(shortest, longest)))


# The date formats that count as explicit.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DATE_PATTERN = rf"(?i)\b(?:\d{{4}}-\d{{2}}-\d{{2}}|(?:{MONTHS})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}|\d{{1,2}}(?:st|nd|rd|th)?\s+(?:{MONTHS}),?\s+\d{{4}})\b"


def explicit_dates(value: Column) -> Column:
    """All dates written out in a text, in order; those that don't exist are left out."""
    number = {m: f"{i:02d}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
    month_of = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])

    def parsed(found: Column) -> Column:
        plain = F.regexp_replace(found, r"(?i)(?<=\d)(?:st|nd|rd|th)\b", "")
        month = month_of[F.lower(F.substring(F.regexp_extract(plain, "([A-Za-z]+)", 1), 1, 3))]
        day = F.lpad(F.regexp_extract(plain, r"(?<!\d)(\d{1,2})(?!\d)", 1), 2, "0")
        written = F.concat_ws("-", F.regexp_extract(plain, r"(\d{4})", 1), month, day)
        return F.when(plain.rlike(r"^\d{4}-"), plain).otherwise(written).try_cast("date")

    found = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(DATE_PATTERN), F.lit(0))
    return F.filter(F.transform(found, parsed), lambda x: x.isNotNull())


def language_samples(text: Column, size: int = 1800) -> Column:
    """The whole text, or its first, middle and last part."""
    middle = F.greatest(F.lit(0), F.floor(F.length(text) / 2) - size // 2)
    parts = F.array(F.substring(text, 1, size), F.substr(text, (middle + 1).cast("int"), F.lit(size)), F.right(text, F.lit(size)))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(parts)


#: Frequent function words, for a cheap language score where no detector is at hand.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "are", "be", "this", "by"),
    "fr": ("le", "la", "les", "de", "des", "et", "en", "un", "une", "que", "dans", "pour", "est", "sur", "par", "du"),
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ist", "im", "des", "auf", "nicht", "ein", "eine"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "un", "una", "por", "con", "para", "del", "se", "las", "es"),
}


def language_confidence(sample: Column, language: str = "en") -> Column:
    """Share of the known stop words of a sample that are the language's own: a pluggable stand-in for a detector."""
    tokens = F.regexp_extract_all(F.lower(sample), F.lit(r"\p{L}+"), F.lit(0))
    hits = {k: F.size(F.filter(tokens, lambda t, k=k: t.isin(*v))) for k, v in STOP_WORDS.items()}
    total = sum(hits.values(), F.lit(0))
    return F.when(total > 0, hits[language] / total).otherwise(F.lit(0.0))


def minimum_confidence(text: Column, language: str = "en") -> Column:
    return F.array_min(F.transform(language_samples(text), lambda s: language_confidence(s, language)))


@functools.cache
def _kinds() -> np.ndarray:
    """What each code point is: 1 white space, 2 a line end, 4 a digit, 8 a letter, 16 a tab."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    white, end, other = (re.compile(x) for x in (f"[{SPACE}]", LINE_END.partition("|")[2], _DIGIT.replace(r"\p{Nd}", "")))
    for c in range(0x110000):
        char = chr(c)
        category = unicodedata.category(char)
        kinds[c] = (4 if category == "Nd" else 8 if category[0] == "L" else 0) | (c < 0x10000 and (bool(white.match(char)) | 2 * bool(end.match(char)) | 4 * bool(other.match(char)))) | 16 * (char == "\t")
    return kinds


def _prose_counts(texts: list[str]) -> np.ndarray:
    """Of each text: tokens, lines with a token, tokens with a digit, numeric lines, tabular lines, tokens with a letter."""
    sizes = np.array([len(x) + 1 for x in texts])
    bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # a line end in front of each text, so that neither tokens nor lines go on from one to the next
    kinds = _kinds()[np.frombuffer("".join(f"\n{x}" for x in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    inside = (kinds & 1) == 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    starts, token = np.flatnonzero(begin), np.cumsum(begin)
    has = lambda flag: np.bincount(token[inside & ((kinds & flag) > 0)] - 1, minlength=len(starts)) > 0
    digit, letter = has(4), has(8)
    ends, tabs = np.flatnonzero(kinds & 2), np.cumsum((kinds & 16) > 0)
    line = np.searchsorted(ends, starts) - 1  # every line begins behind an end
    lines, first = np.unique(line, return_index=True)
    words, with_digit = np.bincount(line, minlength=len(ends))[lines], np.bincount(line, weights=digit, minlength=len(ends))[lines]
    numeric = (with_digit > 0) & (with_digit / words >= 0.4)
    tabular = tabs[starts[first]] - tabs[ends[lines]] >= 2
    of_token, of_line = np.searchsorted(bounds, starts, "right") - 1, np.searchsorted(bounds, ends[lines], "right") - 1
    count = lambda of, which: np.bincount(of[which], minlength=len(texts))
    whole = slice(None)
    return np.stack([count(of_token, whole), count(of_line, whole), count(of_token, digit), count(of_line, numeric), count(of_line, tabular), count(of_token, letter)], axis=1)


_METRICS = ("digit_token_fraction", "numeric_line_fraction", "tabular_line_fraction", "alphabetic_token_fraction")


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in _METRICS]))
def prose_metrics(text: pd.Series) -> pd.DataFrame:
    """struct of the fractions of digit tokens, numeric lines, tabular lines and alphabetic tokens; of nulls for a null.

    Arrow UDF: regular expressions over Unicode classes took several times as long. Texts are counted in arrays, a million characters or one text at a time.
    """
    out = np.full((len(text), len(_METRICS)), np.nan)
    held, size = [], 0

    def finish() -> None:
        if held:
            tokens, lines, *found = _prose_counts([text.iat[i] for i in held]).T
            tokens, lines = np.maximum(1, tokens), np.maximum(1, lines)
            out[held] = np.stack([n / of for n, of in zip(found, (tokens, lines, lines, tokens), strict=True)], axis=1)
        held.clear()

    for i, body in enumerate(text):
        if body is None:
            continue
        if held and size + len(body) > 1_000_000:
            finish()
            size = 0
        held.append(i)
        size += len(body)
    finish()
    return pd.DataFrame(out, columns=list(_METRICS))


# Spacing conventions of a released encyclopedia corpus, undone in this order.
PUNCTUATION_RULES = (
    (r"(?U)\s+@-@\s+", "-"),
    (r"(?U)\s+@,@\s+", ","),
    (r"(?U)\s+@\.@\s+", "."),
    (r"[ \t]+([,.;:!?%)\]])", "$1"),
    (r"([(\[])[ \t]+", "$1"),
    (r"(?U)(?<=\w)[ \t]+('[sdm]|'re|'ve|'ll|n't)\b", "$1"),
)


def restore_punctuation(text: Column) -> Column:
    for pattern, replacement in PUNCTUATION_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


# Words that mark a role rather than a person.
ROLE_WORDS = r"(?i)(?U)\b(?:staff|editor|admin|team|news|press|reuters|agency)\b"


def named_person(value: Column) -> Column:
    """Two to ten words, at least two of them capitalised, no digit and no role word; null is not a person."""
    tokens = words_of(value)
    capital = F.filter(tokens, lambda t: t.rlike(r"^\p{Lu}"))
    found = ~value.rlike(ROLE_WORDS) & F.size(tokens).between(2, 10) & (F.size(capital) >= 2) & ~value.rlike(_DIGIT)
    return F.coalesce(found, F.lit(False))


def byline(text: Column, author: Column) -> Column:
    """struct(author, basis) of a named author credited in the text; null without one."""
    opening, ending = F.substring(text, 1, 1400), F.right(text, F.lit(1800))
    credit = F.regexp_extract(ending, r"\b(?:Reporting|Writing) by ([^;\n)]+)", 1)
    head = F.regexp_extract(opening, r"(?m)^By ([^\n|]+)", 1)
    told = named_person(author) & F.contains(normalized(F.substring(text, 1, 1600)), normalized(author))
    written = F.lit("Explicit reporting/writing credit in article text")
    struct = lambda who, basis: F.struct(F.trim(who).alias("author"), basis.alias("basis"))
    return (
        F.when(told, struct(author, F.lit("Named metadata author also present near article beginning")))
        .when(named_person(credit), struct(credit, written))
        .when(named_person(head), struct(head, written))
    )


def text_slice(text: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text; null when the range is not inside it."""
    inside = (start >= 0) & (start < end) & (end <= F.length(text))
    return F.when(inside, F.substr(text, (start + 1).cast("int"), (end - start).cast("int")))


def book_body(text: Column) -> Column:
    """struct(start, end) of the code points between an e-book's body markers; null when they are missing or reversed."""
    start = r"(?m)^\*\*\* START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\r\n]*\*\*\*\r?\n"
    end = r"(?m)^\*\*\* END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\r\n]*\*\*\*"
    a = F.regexp_instr(text, F.lit(start)) - 1 + F.length(F.regexp_extract(text, start, 0))
    b = F.regexp_instr(text, F.lit(end)) - 1
    found = (F.regexp_instr(text, F.lit(start)) > 0) & (b >= 0) & (a < b)
    return F.when(found, F.struct(a.alias("start"), b.alias("end")))


def last_suffix(value: Column, separator: str = "_") -> Column:
    return F.substring_index(value, separator, -1)


def mapped_group(value: Column, patterns: dict[str, str]) -> Column:
    """The group of the first pattern that matches the whole value, or the value."""
    chain = None
    for pattern, group in patterns.items():
        hit = value.rlike(f"^(?:{pattern})$")
        chain = F.when(hit, group) if chain is None else chain.when(hit, group)
    return value if chain is None else chain.otherwise(value)


def is_decimal_id(value: Column) -> Column:
    return F.coalesce(value.rlike("^[0-9]+$"), F.lit(False))


def flag(value: Column) -> Column:
    """A nullable boolean as 0/1."""
    return value.cast("int")


def quoted_title(title: Column) -> Column:
    """A title as the last part of a reference URL: blanks as underscores, other characters percent-encoded."""
    encoded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(a), F.lit(b))
    return encoded


def wilson(successes: Column, total: Column) -> Column:
    """struct(low, high): the 95 % Wilson interval; null when total is 0."""
    z = 1.959963984540054
    n = total.cast("double")
    p = successes / F.when(n > 0, n)
    denominator = 1 + z * z / n
    center = (p + z * z / (2 * n)) / denominator
    margin = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / denominator
    return F.when(total > 0, F.struct(F.greatest(F.lit(0.0), center - margin).alias("low"), F.least(F.lit(1.0), center + margin).alias("high")))


def lsh_probability(similarity: Column | float, rows: int, bands: int) -> Column | float:
    """The probability that a pair of this similarity (a number or a column) shares a band."""
    return 1 - (1 - similarity**rows) ** bands
