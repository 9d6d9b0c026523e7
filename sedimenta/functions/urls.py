"""Links in HTML text and their resolution against the page address, all as native expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a browser does not treat as markup.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Attribute text of each <a ...>; possessive groups keep the matcher from backtracking.
_ANCHOR = r"""(?is)<a(\s(?:"[^"]*+"|'[^']*+'|[^>"']++)*+)>"""
# Skips whole attributes until href, so "href=" inside another value is not taken.
_HREF = (
    r"""(?is)^(?:\s*+(?!href\s*+=)[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+|\s*+/)*+"""
    r"""\s*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
)
# The named character references of HTML; those of everyday use are tried before the others.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
_COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp")
_ENTITIES_JSON = json.dumps(ENTITIES)
_REPLACEMENT = "\ufffd"
# Numbers 128 to 159 stand for the characters of windows-1252, where it has them.
_WINDOWS = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))
# Generic URI syntax: scheme, authority, path, query, fragment.
_URI = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_BLANK_ENDS = r"^\s+|\s+$"


def _entity(name: Column) -> Column:
    """The text of a named reference; all names but the common ones are one literal, parsed once per query."""
    others = F.try_element_at(F.from_json(F.lit(_ENTITIES_JSON), "map<string,string>"), name)
    found = F.when(name == _COMMON[0], ENTITIES[_COMMON[0]])
    for common in _COMMON[1:]:
        found = found.when(name == common, ENTITIES[common])
    return found.otherwise(others)


def _symbol(code: Column) -> Column:
    """The character with a number; what is no character is the replacement character."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    named = F.when(code.between(128, 159), F.substring(F.lit(_WINDOWS), (code - 127).cast("int"), F.lit(1)))
    return F.coalesce(named, plain, F.lit(_REPLACEMENT))


def _decode_reference(piece: Column) -> Column:
    """Decode the character reference that starts ``piece`` (the text after one ``&``)."""
    named = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
    number = F.regexp_extract(piece, r"^#([0-9]+|[xX][0-9a-fA-F]+);", 1)
    rest = F.regexp_replace(piece, r"^[^;]*;", "")
    digits = F.regexp_replace(F.regexp_replace(number, "^[xX]", ""), "^0+(?=.)", "")
    base = F.when(number.rlike("^[xX]"), 16).otherwise(10)
    # more than eight digits are no character; conv of fewer cannot overflow
    code = F.when(F.length(digits) < 9, F.call_function("conv", digits, base, F.lit(10)).cast("long")).otherwise(0)
    text = F.when(named != "", _entity(named))
    return (
        F.when(number != "", F.concat(_symbol(code), rest))
        .when(text.isNotNull(), F.concat(text, rest))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def decode_entities(text: Column) -> Column:
    """Decode ``&amp;``-style named and numeric references."""
    pieces = F.split(text, "&", -1)
    decoded = F.transform(
        pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode_reference(piece))
    )
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def anchor_hrefs(html: Column) -> Column:
    """Trimmed ``href`` value of every ``<a>`` tag in document order."""
    visible = F.when(html.rlike(r"(?i)<!--|<script\b|<style\b"), F.regexp_replace(html, _HIDDEN, "")).otherwise(html)
    anchors = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(1))
    quoted = F.transform(anchors, lambda a: F.regexp_extract(a, _HREF, 1))
    present = F.filter(quoted, lambda q: q != "")
    return F.transform(
        present,
        lambda q: F.regexp_replace(
            decode_entities(F.regexp_replace(q, r"""^["']|["']$""", "")), _BLANK_ENDS, ""
        ),
    )


def _fold_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments."""
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(
        F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))
    ).otherwise(kept)
    return F.array_join(closed, "/")


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute address of ``href`` found on the page ``base``; null if neither has a scheme."""
    base = F.col(base) if isinstance(base, str) else base
    href = F.col(href) if isinstance(href, str) else href
    b_scheme, b_host, b_path, b_query = (
        F.regexp_extract(base, _URI, 1),
        F.regexp_extract(base, _URI, 2),
        F.regexp_extract(base, _URI, 3),
        F.regexp_extract(base, _URI, 4),
    )
    scheme, host, path, query, fragment = (F.regexp_extract(href, _URI, g) for g in range(1, 6))

    def tail(q: Column) -> Column:
        return F.concat(
            F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""),
            F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
        )

    root = F.concat(F.lower(b_scheme), F.lit("://"))
    folder = F.regexp_replace(b_path, "[^/]*$", "")
    merged = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), path), "/{2,}", "/")
    )
    folded = F.when(merged.rlike(r"(?:^|/)\.\.?(?:/|$)"), _fold_dots(merged)).otherwise(merged)
    rooted = F.when(folded.startswith("/"), folded).otherwise(F.concat(F.lit("/"), folded))
    # the common case needs no taking apart: a plain path from the site's root
    plain = href.startswith("/") & ~href.rlike(r"^//|[?#]|/\.")
    site = F.regexp_extract(base, "^[a-z][a-z0-9+.-]*://[^/?#]*", 0)
    return (
        F.when(plain & (site != ""), F.concat(site, href))
        .when(href == "", base)
        .when((b_scheme == "") & (scheme == ""), F.lit(None))
        .when((scheme != "") & (F.lower(scheme) != F.lower(b_scheme)), href)
        .when(host != "", F.concat(root, host, path, tail(query)))
        .when(
            path == "",
            F.concat(root, b_host, b_path, tail(F.when(query != "", query).otherwise(b_query))),
        )
        .otherwise(F.concat(root, b_host, rooted, tail(query)))
    )
