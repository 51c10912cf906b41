"""Text clean-up and extraction as column expressions."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Commercial phrases that make a keyword useless for attribute mining.
STOP_PHRASES = (
    "sale", "exchange", "emi", "Emi", "cost", "Cost", "Price", "offer", "Offer", "cashback",
    "Cashback", "Cash Back", "cash back", "COD", "Return", "return", "cash on delivery",
    "Cash on Delivery", "Cash on delivery",
)

# Markup removed from item descriptions before they enter a prompt.
DESCRIPTION_TAGS = (
    "<p>", "<em>", "</p>", "</li>", "<li>", "</em>", "<i>", "</i>", "<DIV>", "</DIV>", "<div>",
    "</div>", "<P>", "<STRONG>", "</P>", "</STRONG>",
)

# Answers that mean "no attribute found".
SENTINELS = ("NA", "[]", "NONE OF THE ABOVE")

# Units of a written size in rising order; each is 1,024 times the one before.
SIZE_NAMES = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")
SIZE_UNITS = {name: 1024.0**i for i, name in enumerate(SIZE_NAMES)}

# Seconds per unit of a written duration, by long and short name.
TIME_UNITS = {
    "nanoseconds": 1e-9, "microseconds": 1e-6, "milliseconds": 1e-3, "seconds": 1.0, "mins": 60.0, "hours": 3600.0, "days": 86400.0,
    "ns": 1e-9, "us": 1e-6, "ms": 1e-3, "s": 1.0, "min": 60.0, "hr": 3600.0, "d": 86400.0,
    "sec": 1.0, "minutes": 60.0, "h": 3600.0, "hour": 3600.0, "day": 86400.0, "week": 604800.0,
}


def phrase_pattern(phrases: Sequence[str], literal: bool = False) -> str:
    """One alternation over the phrases.

    Default: whole words, any case. `literal`: the phrase between two spaces,
    case as written, so a phrase at either end of the text is not seen.
    """
    body = "|".join(re.escape(p).replace(r"\ ", " ") for p in phrases)
    return f" (?:{body}) " if literal else rf"(?i)\b(?:{body})\b"


def has_stop_phrase(text: str | Column, phrases: Sequence[str] = STOP_PHRASES, literal: bool = False) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")).rlike(phrase_pattern(phrases, literal))


def strip_all(text: Column, patterns: Sequence[str]) -> Column:
    """Remove several regular expressions in order."""
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return text


def strip_literals(text: Column, literals: Sequence[str]) -> Column:
    """Remove all literals in one pass; a shared beginning is matched once, not per literal."""
    shared = os.path.commonprefix(list(literals))
    rest = "|".join(re.escape(x[len(shared):]) for x in literals)
    return F.regexp_replace(text, f"{re.escape(shared)}(?:{rest})", "")


def strip_phrase(text: Column, phrase: str) -> Column:
    """The text without a literal phrase, wherever it stands."""
    return F.replace(text, F.lit(phrase), F.lit(""))


def conform_name(name: Column, suffix: str = "?standardized_values") -> Column:
    """Drop the marker that follows a standardised attribute, then dots to underscores."""
    bare = F.replace(name, F.lit("." + suffix.lstrip("?")), F.lit(""))
    return F.translate(F.replace(bare, F.lit(suffix), F.lit("")), ".", "_")


def number_from_text(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def tag_values(text: Column, tag: str) -> Column:
    """All texts inside <tag>…</tag>; a tag left open runs to the end of the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}>(.*?)(?:</{tag}>|$)"), F.lit(1))


def tag_text(text: Column, tag: str) -> Column:
    """Tag contents joined by comma, inner item markup and line ends removed, & restored."""
    joined = F.array_join(tag_values(text, tag), ",")
    clean = F.regexp_replace(joined, r"</?item>|\n", "")
    return F.replace(clean, F.lit("&amp;"), F.lit("&"))


def first_answer(text: Column, tag: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The first text inside <tag>…</tag> that is an answer; null where none is."""
    bare = F.transform(tag_values(text, tag), lambda x: F.trim(F.regexp_replace(x, r"</?item>|\n", "")))
    return F.get(F.filter(bare, lambda x: (x != "") & ~x.isin(*sentinels)), F.lit(0))


def normalise_label(text: Column, remove: str = " -_") -> Column:
    return F.translate(F.lower(text), remove, "")


def underscore_label(text: Column) -> Column:
    return F.translate(F.lower(text), " -/", "___")


# Words kept in lower case inside a display label.
SMALL_WORDS = ("of", "in", "the")


def display_label(text: Column) -> Column:
    """Underscore label to Title Case, small words in lower case."""
    words = F.split(F.lower(text), "[ _-]+")
    shown = F.transform(words, lambda w: F.when(w.isin(*SMALL_WORDS), w).otherwise(F.initcap(w)))
    return F.array_join(shown, " ")


def collapse_repeats(text: Column, separator: str) -> Column:
    quoted = re.escape(separator)
    return F.regexp_replace(text, f"(?:{quoted}){{2,}}", separator)


def measure(text: Column, units: dict[str, float], upper: bool = False) -> Column:
    """`2.5 MB` to its base unit; null when the number or the unit is not known."""
    number = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$", 1)
    unit = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$", 2)
    unit = F.upper(unit) if upper else F.lower(unit)
    factor = F.create_map(*[F.lit(x) for kv in units.items() for x in (kv[0], float(kv[1]))])
    return number.try_cast("double") * F.try_element_at(factor, unit)


def render_template(template: str, **columns: str | Column) -> Column:
    """Fill `{name}` fields from columns; a null shows as empty text."""
    parts: list[Column] = []
    for chunk in re.split(r"(\{\w+\})", template):
        if re.fullmatch(r"\{\w+\}", chunk):
            source = columns[chunk[1:-1]]
            column = F.col(source) if isinstance(source, str) else source
            parts.append(F.coalesce(column.cast("string"), F.lit("")))
        elif chunk:
            parts.append(F.lit(chunk))
    return F.concat(*parts)


def template_fields(template: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", template)))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of the record in name order. Values carry their length and nulls have none,
    so two different records never give the same text."""
    def entry(name: str) -> Column:
        value = F.col(name).cast("string")
        given = F.concat(F.lit(f"{name}:"), F.length(value).cast("string"), F.lit("="), value)
        return F.coalesce(given, F.lit(f"{name}-"))

    return F.sha2(F.concat_ws("\n", *[entry(c) for c in sorted(columns)]), 256)


COUNTS = ("n_words", "n_lines", "n_digits", "n_marks")
# Texts whose bytes are looked at together.
PIECE = 500

_WHITE, _LINE, _DIGIT, _MARK = 1, 2, 4, 8
# What a byte of UTF-8 is: a character beyond ASCII is a mark, counted by its first byte.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[b for b in range(256) if not 0x80 <= b < 0xC0 and not re.match(rb"[\w\s]", bytes([b]))]] = _MARK
_KINDS[list(b" \t\n\x0b\f\r")] = _WHITE
_KINDS[ord("\n")] |= _LINE
_KINDS[list(b"0123456789")] = _DIGIT


def _byte_counts(texts: pa.Array) -> list[np.ndarray]:
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)
    kinds = _KINDS[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    white = (kinds & _WHITE).view(bool)
    opens = white.copy()
    opens[1:] &= ~white[:-1]
    first = ends[:-1][ends[:-1] < len(kinds)]
    opens[first] = white[first]
    runs, lines, digits, marks = (np.diff(np.searchsorted(np.flatnonzero(x), ends)) for x in (opens, kinds & _LINE, kinds & _DIGIT, kinds & _MARK))
    return [runs + 1, lines + 1, digits, marks]


def text_counts(text: Column) -> Column:
    r"""Parts between runs of `\s+`, parts between line ends, digits `[0-9]` and characters of `[^\w\s]` of a text, as one struct; null for a null.

    Counted on the bytes in one pass per batch; the classes are those of ASCII.
    """
    @F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
    def counted(texts: pa.Array) -> pa.Array:
        parts = [_byte_counts(texts.slice(at, PIECE)) for at in range(0, len(texts), PIECE)]
        columns = [pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in zip(*parts)] if parts else [pa.array([], pa.int64())] * len(COUNTS)
        return pa.StructArray.from_arrays(columns, list(COUNTS), mask=texts.is_null())

    return counted(text)
