"""Column functions over text."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

# Named entities of HTML that are one character; a no-break space is read as a blank.
HTML_ENTITIES = {n.rstrip(";"): " " if c == "\xa0" else c for n, c in html5.items() if n.endswith(";") and len(c) == 1}
BLOCK_TAGS = "p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|title|body|head|html|pre|blockquote"


def preview(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def clip_cell(value: Column, limit: int = 100) -> Column:
    """Cell text for a rendered sheet: null is empty, long text ends in dots."""
    text = F.coalesce(value, F.lit(""))
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def clip_error(message: Column, limit: int = 1900) -> Column:
    return F.substring(message, 1, limit)


def size_in(size: Column, unit: int) -> Column:
    """Bytes in a larger unit with two decimals."""
    return F.round(size / F.lit(float(unit)), 2)


# The entities that nearly all pages hold; they are told apart without a search in the map of all names.
FREQUENT_ENTITIES = ("nbsp", "lt", "gt", "quot", "amp")


def resolve_entities(text: Column) -> Column:
    """Named and numeric entities as characters, each read once; unknown ones stay as they are.

    The text is cut before every ampersand, and each part is looked at by itself.
    Numbers and rare names cost more than the frequent names, so each way is taken
    only for parts that need it.
    """
    names = F.from_json(F.lit(json.dumps(HTML_ENTITIES)), "map<string,string>")

    def numeric(piece: Column) -> Column:
        entity = F.regexp_extract(piece, r"^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});", 1)
        digits = F.when(entity.rlike("^#[xX]"), F.conv(F.substring(entity, 3, 8), 16, 10)).otherwise(F.substring(entity, 2, 8)).try_cast("int")
        # A code point as text, by way of its bytes in UTF-32.
        valid = digits.between(1, 0x10FFFF) & ~digits.between(0xD800, 0xDFFF)
        number = F.when(digits == 160, " ").when(valid, F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32"))
        return F.when((entity == "") | number.isNull(), piece).otherwise(F.concat(number, F.substr(piece, F.length(entity) + 3)))

    def named(piece: Column) -> Column:
        entity = F.regexp_extract(piece, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        char = F.when(entity != "", F.try_element_at(names, entity))
        return F.when(char.isNull(), piece).otherwise(F.concat(char, F.substr(piece, F.length(entity) + 3)))

    def part(piece: Column) -> Column:
        out = F.when(~piece.startswith("&"), piece).when(piece.startswith("&#"), numeric(piece))
        for name in FREQUENT_ENTITIES:
            out = out.when(piece.startswith(f"&{name};"), F.concat(F.lit(HTML_ENTITIES[name]), F.substring(piece, len(name) + 3, 2**31 - 1)))
        return out.otherwise(named(piece))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "(?=&)"), part), "")).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Visible text of a page.

    Scripts, styles and comments go first, block tags become line breaks, other
    tags vanish, entities are resolved and white space is squeezed.
    """
    out = F.regexp_replace(html, r"(?is)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<script\b.*?</script\s*>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b.*?</style\s*>", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    out = resolve_entities(out)
    out = F.regexp_replace(out, r"[ \t\r\f]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def term_count(text: Column, terms: list[str]) -> Column:
    """How often any of the terms stands in the text as a whole word."""
    body = "|".join(sorted((r"\Q" + t.lower() + r"\E" for t in terms), key=len, reverse=True))
    pattern = r"(?<![\p{L}\p{N}])(?:" + body + r")(?![\p{L}\p{N}])"
    return F.regexp_count(F.lower(text), F.lit(pattern))


def readable_share(text: Column) -> Column:
    """Share of characters that are letters, digits, blanks or common punctuation."""
    odd = F.regexp_replace(text, r"[\p{L}\p{N}\s.,;:!?'\"()\-/]", "")
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(1.0 - F.length(odd) / F.length(text))
