"""Text expressions. Every function takes and returns a ``Column``.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII-only, so the Unicode classes are
spelled out once here and used everywhere else.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from labeltext.constants import SEQUENCE_FILTERS, STOP_WORDS

# Unicode character classes, written for use inside [...].
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
DIGIT = r"\p{Nd}"

VARIANTS = ("basic", "parallel", "model")


def as_text(c: Column) -> Column:
    """Missing text reads as the word ``nan``, as it does in a pandas export."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


# --- whole-word codes ---------------------------------------------------------

def code_pattern(vocab: Sequence[str]) -> str:
    """Regex for any code of ``vocab`` as a whole word; group 1 is the code.

    The look-ahead on the first letter lets the matcher reject most positions
    with one character test before it tries the look-behind.
    """
    firsts = "".join(re.escape(ch) for ch in sorted({code[0] for code in vocab}))
    codes = "|".join(re.escape(code) for code in vocab)
    return rf"(?=[{firsts}])(?<![{WORD}])({codes})(?![{WORD}])"


def label_of(c: Column, vocab: Sequence[str]) -> Column:
    """Leftmost whole-word code in the upper-cased text, else null."""
    return F.nullif(F.regexp_extract(F.upper(c), code_pattern(vocab), 1), F.lit(""))


def mentions(c: Column, vocab: Sequence[str]) -> Column:
    """Whether the upper-cased text holds any code as a whole word."""
    return F.upper(as_text(c)).rlike(code_pattern(vocab))


def is_blank(c: Column) -> Column:
    """Empty after trimming every kind of white space (``trim`` knows only ' ')."""
    return ~as_text(c).rlike(rf"[^{SPACE}]")


# --- tokens -------------------------------------------------------------------

def remove_stop_words(tokens: Column, words: Iterable[str] = STOP_WORDS) -> Column:
    """Drop stop words from a token array.

    ``isin`` with more than a handful of literals becomes a hash-set probe, also
    inside the lambda, so the cost per token does not depend on the list.
    """
    words = list(words)
    if not words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(words))


def word_count(c: Column) -> Column:
    """Number of white-space separated words; 0 for empty text."""
    return F.regexp_count(c, F.lit(rf"[^{SPACE}]+"))


def tokenize_words(c: Column) -> Column:
    """Lower-cased maximal runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"([{WORD}]{{2,}})"), F.lit(1))


def tokenize_keras(c: Column) -> Column:
    """Lower-cased words between filter characters and spaces; apostrophes stay."""
    spaced = F.translate(F.lower(c), SEQUENCE_FILTERS, " " * len(SEQUENCE_FILTERS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


# --- cleaning -----------------------------------------------------------------

#: Character references, as HTML5 reads them.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _named(s: Column) -> Column:
    """The characters of a named reference (without ``&``); a longest known beginning counts, as for old names."""
    by_start: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        by_start.setdefault(name[:2], {})[name] = value
    table = F.from_json(F.lit(json.dumps(by_start)), "map<string,map<string,string>>")  # folded into one literal
    look = lambda x: F.try_element_at(F.try_element_at(table, F.substring(x, 1, 2)), x)
    old = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
    start = F.regexp_extract(s, f"^({old})", 1)
    rest = F.substring(s, F.length(start) + 1, F.length(s))
    return F.coalesce(look(s), F.concat(look(start), rest), F.concat(F.lit("&"), s))


def _numbered(s: Column) -> Column:
    """The character of a numeric reference (without ``&``), with HTML5's replacements."""
    hexed = F.substring(s, 2, 1).isin("x", "X")
    digits = F.regexp_replace(F.regexp_extract(s, "^#[xX]?([0-9a-fA-F]+)", 1), "^0+", "")
    short = F.substring(F.concat(F.lit("0"), digits), 1, 10)
    n = F.when(F.length(digits) > 7, 1 << 30).when(hexed, F.conv(short, 16, 10)).otherwise(short).cast("bigint")
    point = lambda x: F.decode(F.unhex(F.lpad(F.hex(x), 8, "0")), "UTF-32")
    # 0x80 to 0x9f stand for that code page, where it has a character
    page = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 65536 >= 65534)
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
        .when(n.between(0x80, 0x9F), F.substring(F.lit(page), (n - 0x7F).cast("int"), F.lit(1)))
        .when(control, F.lit(""))
        .otherwise(point(n))
    )


def unescape_html(c: Column) -> Column:
    """Decode HTML character references, one pass, in the row.

    A text with an ``&`` is split at its references, which are decoded and put back
    between the pieces; other texts are returned as they are.
    """
    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    plain = lambda r: F.substring(r, 2, F.length(r))
    decoded = F.transform(found, lambda r: F.when(r.startswith("&#"), _numbered(plain(r))).otherwise(_named(plain(r))))
    pieces = F.zip_with(F.split(c, _REFERENCE, -1), decoded, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def _forum_letters(c: Column) -> Column:
    """Shared tail of the two forum variants: words of plain letters, spaced.

    Two passes stand for five steps. Punctuation, symbols, marks and decimal
    digits vanish; what is left besides a-z (other scripts, other numbers, white
    space) turns into single spaces.
    """
    lowered = F.replace(F.lower(c), F.lit("_"), F.lit(" "))
    squeezed = F.regexp_replace(lowered, r"([^\n])\1{2,}", "$1")
    kept = F.regexp_replace(squeezed, rf"[^\p{{L}}\p{{Nl}}\p{{No}}{SPACE}]+", "")
    return F.regexp_replace(kept, r"[^a-z]+", " ")


def clean_tokens(
    c: Column, variant: str = "parallel", stop_words: Iterable[str] = STOP_WORDS
) -> Column:
    """The words left by cleaning, as an array; see :func:`clean_text`."""
    text = as_text(c)
    if variant == "basic":
        text = unescape_html(text)
        text = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\\n"), F.lit(" "))
        spaced, dropped = _forum_letters(text), list(stop_words)
    elif variant == "parallel":
        spaced, dropped = _forum_letters(text), list(stop_words)
    elif variant == "model":
        spaced, dropped = _model_letters(text), []
    else:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    return F.filter(F.split(spaced, " "), lambda w: ~w.isin(["", *dropped]))


def _model_letters(c: Column) -> Column:
    # Most texts have neither a URL nor a tag: a substring test, far cheaper than
    # a regex pass, decides whether the pass is needed.
    text = F.lower(c)
    has_url = text.contains("http") | text.contains("www")
    no_url = F.regexp_replace(text, rf"http[^{SPACE}]+|www[^{SPACE}]+", "")
    text = F.when(has_url, no_url).otherwise(text)
    # An opening bracket that is never closed is matched to the end of its line and
    # put back as group 1, which keeps texts full of such brackets linear.
    no_tag = F.regexp_replace(text, r"<[^\n>]*>|(<[^\n>]*)", "$1")
    text = F.when(text.contains("<"), no_tag).otherwise(text)
    text = F.regexp_replace(text, rf"[^a-z{SPACE}]+", "")
    return F.regexp_replace(text, r"[^a-z]+", " ")


def clean_text(
    c: Column, variant: str = "parallel", stop_words: Iterable[str] = STOP_WORDS
) -> Column:
    """Clean a text.

    ``basic``     decode entities, newline and literal ``\\n`` to space, then as
                  ``parallel``.
    ``parallel``  lower-case, ``_`` to space, runs of three or more equal
                  characters to one, drop punctuation and digits, other scripts
                  to space, squeeze white space, drop stop words.
    ``model``     lower-case, drop URLs, tags and all but a-z, squeeze white
                  space; no stop words.
    """
    if variant == "model":
        return F.trim(_model_letters(as_text(c)))
    return F.array_join(clean_tokens(c, variant, stop_words), " ")
