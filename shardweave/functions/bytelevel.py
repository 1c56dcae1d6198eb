"""Byte-level pre-tokenisation as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# How text is cut into words, and the special tokens in id order.
WORD_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
UNK, BOS, EOS = "[UNK]", "[BOS]", "[EOS]"
SPECIALS = [UNK, BOS, EOS]

# Bytes that stand for themselves; the others take the code points from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_MOVED = [b for b in range(256) if b not in set(_PRINTABLE)]
_FROM = "".join(map(chr, _MOVED))
_TO = "".join(chr(256 + i) for i in range(len(_MOVED)))

BYTE_TO_CHAR = {b: chr(b) for b in _PRINTABLE} | dict(zip(_MOVED, _TO))


def with_prefix_space(text: Column) -> Column:
    return F.when(text.startswith(" "), text).otherwise(F.concat(F.lit(" "), text))


def words(text: Column, prefix_space: bool = True) -> Column:
    """Words of one text, in order; joined they spell it, after one leading space."""
    source = with_prefix_space(text) if prefix_space else text
    found = F.regexp_extract_all(source, F.lit(WORD_PATTERN), F.lit(0))
    # The leading space must not turn an empty text into a word.
    return F.when(text == "", F.array().cast("array<string>")).otherwise(found)


def literals(specials: list[str]) -> str:
    """Pattern of any of the special tokens, as they are spelled."""
    return "|".join(re.sub(r"(\W)", r"\\\1", s) for s in specials)


def parts_pattern(specials: list[str]) -> str:
    """Pattern of special tokens and of the stretches between them."""
    literal = literals(specials)
    return rf"(?s)(?:{literal})|.+?(?=(?:{literal})|\z)"


def words_with_specials(text: Column, specials: list[str], prefix_space: bool = True) -> Column:
    """Like ``words``, but literal special tokens in the text are kept whole.

    The stretches between them count as texts of their own.
    """
    literal = literals(specials)
    parts = F.regexp_extract_all(text, F.lit(parts_pattern(specials)), F.lit(0))
    split = F.flatten(F.transform(parts, lambda p: F.when(
        p.isin(specials), F.array(p)).otherwise(words(p, prefix_space))))
    return F.when(text.rlike(literal), split).otherwise(words(text, prefix_space))


def to_byte_chars(word: Column) -> Column:
    """One printable character per UTF-8 byte of ``word``."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _FROM, _TO)


def from_byte_chars(chars: Column) -> Column:
    """Inverse of ``to_byte_chars``; broken byte sequences become U+FFFD."""
    raw = F.encode(F.translate(chars, _TO, _FROM), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))
