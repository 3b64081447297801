"""Column expressions over raw HTML. All run in the JVM; no parser library.

Patterns avoid look-around and back-references wherever the result is checked
against another SQL engine, and use ``[ \\t\\n\\r]`` for white space. An element, comment or
tag that is not closed runs to the end of the page, as in parsers; so every match uses
up what it has looked at, and no page takes more than linear time. Only ``nav`` and ``footer``
lose no text by it: one that is not closed keeps what follows.
"""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import none_if_empty

_REST = r"(?:[ \t\n\r/][^>]*)?(?:>|\z)"  # of a tag, after its whole name


def whole_element(tag: str) -> str:
    """Pattern of an element with all that is in it."""
    return rf"<{tag}{_REST}.*?(?:</{tag}{_REST}|\z)"


_HIDDEN = rf"(?is){whole_element('script')}|{whole_element('style')}|<!--.*?(?:-->|\z)"
_SPACE = r"[ \t\n\r]+"
_TAG = r"<[a-zA-Z/!?][^>]*(?:>|\z)"
# A tag whose quoted values may hold a ``>``, up to so many of them; and a page that has such a value.
_QUOTING_TAG = r"""<[a-zA-Z/!?](?>(?:[^>=]++|=[ \t\n\r]*+(?:"[^"]*+"|'[^']*+')?+){0,300})>"""
_QUOTED_END = r"""=[ \t\n\r]*+(?:"[^">]*+>|'[^'>]*+>)"""
# How deep elements of one name may be nested to be taken out whole.
LEVELS = 5


def language(html: Column) -> Column:
    """Two-letter language of the ``<html>`` tag, else of a ``<meta>`` tag."""
    tag = F.regexp_extract(html, r"""(?i)<html[^<>]*[ \t\n\r]lang=["']?([a-z]{2})""", 1)

    # Whole tags first, then what follows the name in each: no length is tried twice.
    def told(meta: Column) -> Column:
        name = r"""(?is)(?:http-equiv=["']?content-language|name=["']?lang)["']?(.*)"""
        return F.regexp_extract(
            F.regexp_extract(meta, name, 1), r"""(?is)^.*content=["']?([a-z]{2})""", 1
        )

    metas = F.regexp_extract_all(html, F.lit("(?i)<meta[^<>]*"), F.lit(0))
    first = F.get(F.filter(F.transform(metas, told), lambda found: found != ""), F.lit(0))
    return F.lower(F.coalesce(none_if_empty(tag), first))


def plain(markup: Column) -> Column:
    """Tags to blanks, entities decoded, white space collapsed."""
    return F.trim(F.regexp_replace(_decoded(_without_tags(markup)), _SPACE, " "))


def _pieces(text: Column, mark: str, one) -> Column:
    """Text with what follows each mark changed by ``one``; the text before the first mark stays."""
    pieces = F.split(text, mark)
    changed = F.transform(pieces, lambda p, nth: F.when(nth == 0, p).otherwise(one(p)))
    return F.when(F.contains(text, F.lit(mark)), F.array_join(changed, "")).otherwise(text)


def _without_tags(markup: Column) -> Column:
    """Most pages take the plain pattern; only one with a ``>`` in a value needs its quotes read."""
    return _once(
        markup,
        lambda page: F.regexp_replace(
            F.when(page.rlike(_QUOTED_END), F.regexp_replace(page, _QUOTING_TAG, " ")).otherwise(page), _TAG, " "
        ),
    )


def _decoded(text: Column) -> Column:
    """Numeric references and named entities to characters; what is none stays as it is.

    A character that comes out of one is not looked at again.
    """
    known = {name: " " if name == "nbsp" else chr(code) for name, code in name2codepoint.items()}
    # One constant, which Spark reads once.
    names = F.from_json(F.lit(json.dumps(known)), "map<string, string>")

    def one(piece: Column) -> Column:
        number = F.regexp_extract(piece, r"^#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        value = F.when(
            F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 7), 16, 10)
        ).otherwise(number).try_cast("int")
        sound = value.between(1, 0x10FFFF) & ~value.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, value).otherwise(32)), 8, "0")), "UTF-32")
        name = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]{1,7});", 1)
        meant = F.element_at(names, name)
        asis = F.concat(F.lit("&"), piece)
        # The first characters tell most pieces that are nothing.
        return (
            F.when(F.length(piece) < 3, asis)
            .when(piece.startswith("#"), F.when(sound, F.concat(char, F.substr(piece, F.length(number) + 3))).otherwise(asis))
            .when(meant.isNotNull(), F.concat(meant, F.substr(piece, F.length(name) + 2)))
            .otherwise(asis)
        )

    return _pieces(text, "&", one)


def _inside(html: Column, tag: str) -> Column:
    pattern = rf"(?is)<{tag}{_REST}(.*?)(?:</{tag}{_REST}|\z)"
    return none_if_empty(F.regexp_extract(html, pattern, 1))


def without_hidden(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, _HIDDEN, " ")


def _without_closed(html: Column, tag: str) -> Column:
    """The page without such elements; the text after a tag that is never closed stays.

    A round takes out the innermost ones: those whose opening tag is followed by a closing one before
    the next opening. After ``LEVELS`` rounds, what was closed within so many others is gone.
    """
    opening, closing = rf"(?i)<{tag}{_REST}", rf"(?is)^.*?</{tag}{_REST}"

    def inner(piece: Column) -> Column:
        cut = F.regexp_replace(piece, closing, " ")
        return F.when(cut != piece, cut).otherwise(F.concat(F.lit(f"<{tag}>"), piece))

    def joined(pieces: Column) -> Column:
        changed = F.transform(pieces, lambda p, nth: F.when(nth == 0, p).otherwise(inner(p)))
        return F.array_join(changed, "")

    def rounds(page: Column, left: int) -> Column:
        if not left:
            return page
        # Nothing changes where no tag is opened and closed again, and then no later round does.
        done = _once(
            _once(F.split(page, opening), joined),
            lambda next_: F.when(next_ == page, page).otherwise(rounds(next_, left - 1)),
        )
        return F.when(page.rlike(opening), done).otherwise(page)

    return _once(html, lambda page: rounds(page, LEVELS))


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def title(html: Column) -> Column:
    return plain(F.coalesce(_inside(html, "title"), _inside(html, "h1")))


def body_text(visible: Column) -> Column:
    """Readable text of a page given without scripts: the article, else the body."""
    main = F.coalesce(_inside(visible, "article"), _inside(visible, "body"))
    return plain(_without_closed(_without_closed(main, "nav"), "footer"))


# --- Elements ---------------------------------------------------------------


def open_tag(tag: str, cls: str, exact: bool) -> str:
    """Pattern of an opening tag with a class: the whole attribute, or one token of it."""
    name = re.escape(cls)
    value = name if exact else rf"(?:[^\"']*[ \t\n\r])?{name}(?:[ \t\n\r][^\"']*)?"
    return rf"(?i)<{tag}[ \t\n\r](?:[^>]*[ \t\n\r])?class=[\"']{value}[\"'][^>]*>"


def _after(html: Column, opening: str, nth: int) -> Column:
    """What follows the nth opening tag; NULL if there are fewer.

    Spark compiles the pattern of a ``split`` anew for every row, that of an extraction once.
    """
    found = rf"(?s)\A{rf'(?>.*?(?:{opening}))' * nth}(.*)"
    return F.get(F.regexp_extract_all(html, F.lit(found), F.lit(1)), F.lit(0))


def element(html: Column, tag: str, opening: str, nth: int = 1) -> Column:
    """Markup inside the nth element whose opening tag matches; NULL if there is none.

    The end is found by counting nested tags of the same name, so that inner
    elements do not cut the outer one short.
    """
    pieces = F.split(_after(html, opening, nth), rf"(?i)(?=</?{tag}[ \t\n\r>])")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("inner"))

    def change(piece: Column) -> Column:
        return F.when(piece.rlike(rf"(?i)^</{tag}"), -1).when(piece.rlike(rf"(?i)^<{tag}"), 1).otherwise(0)

    def step(seen: Column, change: Column) -> Column:
        depth = F.when(seen["depth"] <= 0, 0).otherwise(seen["depth"] + change)
        # Pieces inside are counted and joined once.
        inner = seen["inner"] + F.when(depth > 0, 1).otherwise(0)
        return F.struct(depth.alias("depth"), inner.alias("inner"))

    def joined(pieces: Column) -> Column:
        inner = F.aggregate(F.transform(pieces, change), start, step)["inner"]
        return F.array_join(F.slice(pieces, 1, inner), "")

    # The pieces are counted and joined, but the page is taken apart once.
    return _once(pieces, joined)


def element_text(html: Column, tag: str, opening: str, nth: int = 1) -> Column:
    return F.regexp_replace(element(html, tag, opening, nth), r"<[a-zA-Z/!?][^>]*(?:>|\z)", "")


def attribute(html: Column, tag: str, name: str) -> Column:
    """Attribute of the first such element; NULL if the element or attribute is absent."""
    opening = F.get(F.regexp_extract_all(html, F.lit(rf"(?i)<{tag}([ \t\n\r][^>]*)>"), F.lit(1)), F.lit(0))
    pattern = rf"(?i)[ \t\n\r]{name}=[\"']([^\"']*)[\"']"
    # The page is searched once, however often the tag is looked at.
    return _once(opening, lambda tag: F.when(tag.rlike(pattern), F.regexp_extract(tag, pattern, 1)))
