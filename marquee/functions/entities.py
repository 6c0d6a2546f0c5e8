"""HTML entity decoding with built-in functions only."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT = chr(0xFFFD)

# What may be an entity: &#38; &#x26; &amp; and names without the closing mark.
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# Names that count without ";" (the old ones), and what 128-159 stand for in windows-1252.
_OPEN_NAMES = {name: text for name, text in html5.items() if not name.endswith(";")}
_WINDOWS = {str(n): bytes([n]).decode("cp1252", errors="replace") for n in range(128, 160)}
_WINDOWS.update({k: chr(int(k)) for k, v in _WINDOWS.items() if v == REPLACEMENT})


def _table(values: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chr(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _number(code: Column) -> Column:
    """The character of a numeric entity, with the HTML rules for codes that are not characters."""
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    low = (code.between(0x1, 0x1F) & ~code.isin(9, 10, 12, 13)) | (code == 0xB) | (code == 0x7F)
    not_a_character = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (
        F.when(code == 13, F.lit("\r"))
        .when(code.between(128, 159), F.element_at(_table(_WINDOWS), code.cast("string")))
        .when(bad, F.lit(REPLACEMENT))
        .when(low | not_a_character, F.lit(""))
        .otherwise(_chr(code))
    )


def _decimal(digits: Column) -> Column:
    """A decimal code; one too long for a long is past every character anyway."""
    return F.coalesce(digits.try_cast("bigint"), F.lit(0x110000))


def _hexadecimal(digits: Column) -> Column:
    plain = F.ltrim(digits, F.lit("0"))
    return F.when(F.length(plain) > 7, F.lit(0x110000)).otherwise(
        F.conv(F.concat(F.lit("0"), plain), 16, 10).cast("bigint")
    )


def _named(name: Column) -> Column:
    """A named entity, or its longest known beginning, or the text as it was."""
    beginnings = F.transform(
        F.when(F.length(name) > 2, F.sequence(F.length(name) - 1, F.lit(2), F.lit(-1))),
        lambda n: F.concat(
            F.element_at(_table(_OPEN_NAMES), F.substring(name, F.lit(1), n)),
            F.substring(name, n + F.lit(1), F.length(name)),
        ),
    )
    return F.coalesce(
        F.element_at(_table(html5), name),
        F.get(F.filter(beginnings, lambda b: b.isNotNull()), F.lit(0)),
        F.concat(F.lit("&"), name),
    )


def _entity(piece: Column) -> Column:
    """Decode one piece that is a whole entity."""
    bare = F.rtrim(piece, F.lit(";"))
    return (
        F.when(piece.rlike("^&#[xX]"), _number(_hexadecimal(F.substring(bare, F.lit(4), F.length(bare)))))
        .when(piece.startswith("&#"), _number(_decimal(F.substring(bare, F.lit(3), F.length(bare)))))
        .otherwise(_named(F.substring(piece, F.lit(2), F.length(piece))))
    )


def decode_entities(col: Column) -> Column:
    """Decode every HTML entity once. Texts without ``&`` are passed through untouched."""

    def decode(text: Column) -> Column:
        between = F.split(text, ENTITY)
        found = F.concat(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), F.array(F.lit("")))
        return F.array_join(
            F.zip_with(between, found, lambda b, e: F.concat(b, F.when(e == "", e).otherwise(_entity(e)))), ""
        )

    return F.when(F.contains(col, F.lit("&")), let(col, decode)).otherwise(col)


def unescape_html(col: Column | str) -> Column:
    """``&amp;`` to ``&`` first, then all entities, so that doubly escaped text comes out plain."""
    col = F.col(col) if isinstance(col, str) else col
    return decode_entities(F.replace(col, F.lit("&amp;"), F.lit("&")))
