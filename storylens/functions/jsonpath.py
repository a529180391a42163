"""JSON expressions: embedded script blocks (G3/G4/P10/P11) and the deep path (P5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storylens.functions.strings import ColumnOrName, _col

# Fixed values that must equal the captured pages' format.
# Script blocks that can carry the story JSON: `type` first, `data-sjs` after it.
SJS_BLOCK_PATTERN = r'(?s)<script type="application/json"[^>]*data-sjs[^>]*>(.*?)</script>'
# Marker that a block carries the stories feed.
STORY_MARKER = "xdt_api__v1__feed__reels_media"
# Path from the document root to the reels list.
REELS_PATH = ("$.require[0][3][0].__bbox.require[0][3][1].__bbox.result.data"
              ".xdt_api__v1__feed__reels_media.reels_media")


def script_blocks(html: ColumnOrName, pattern: str = SJS_BLOCK_PATTERN) -> Column:
    """Contents of every matching script block, in document order."""
    return F.regexp_extract_all(_col(html), F.lit(pattern), 1)


#: Closes a text that is parsed as the first element of an array.
END = '{"storylens_end":true}'


def closed(text: ColumnOrName) -> Column:
    """``text`` as the first of two elements of a JSON array.

    A parser stops after the first value it has read, so junk behind a value goes
    unnoticed. Behind ``text`` stands a second element here: it is where
    it belongs only if ``text`` is one whole value and nothing else.
    """
    return F.concat(F.lit("["), _col(text), F.lit("," + END + "]"))


def bind(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strict_variant(v: Column) -> Column:
    """Whether the VARIANT of a ``closed`` text holds one whole value."""
    return F.coalesce(F.try_variant_get(v, "$[1].storylens_end", "boolean"), F.lit(False))


def strict_text(text: ColumnOrName) -> Column:
    """``text`` as JSON text if it is one whole value, else NULL.

    Accepts what the VARIANT parser refuses: repeated keys, NaN, any size.
    """
    return bind(F.from_json(closed(text), "array<string>"),
                lambda x: F.when((F.size(x) == 2) & (F.get(x, F.lit(1)) == END), F.get(x, F.lit(0))))


def _require(block: Column) -> Column:
    """One parse of a block: is it one whole value, and its ``require``."""
    parsed = F.from_json(closed(block), "array<struct<require:string,storylens_end:boolean>>")
    def found(x: Column) -> Column:
        whole = (F.coalesce(F.size(x) == 2, F.lit(False))
                 & F.coalesce(F.get(x, F.lit(1)).getField("storylens_end"), F.lit(False)))
        # a list or a text is a whole value, too, without a require
        return F.struct((whole | strict_text(block).isNotNull()).alias("ok"),
                        F.when(whole, F.get(x, F.lit(0)).getField("require")).alias("req"))

    return bind(parsed, found)


def _deciding(h: Column, marker: str, pattern: str, parse) -> Column:
    """The first marked block that fails to parse or has a ``require``; pages without the marker skip the regex."""
    marked = F.when(h.contains(marker), F.filter(script_blocks(h, pattern), lambda b: b.contains(marker)))
    return F.get(F.filter(F.transform(marked, parse),
                          lambda x: ~x.getField("ok") | x.getField("req").isNotNull()), F.lit(0))


def _parsed_block(block: Column) -> Column:
    """One parse of a block into a VARIANT: is it one whole value, has it a ``require``, and the VARIANT (``closed``).

    What the VARIANT parser refuses (repeated keys, NaN, size limit) has its document as ``text`` instead.
    """
    no_variant, no_text = F.lit(None).cast("variant"), F.lit(None).cast("string")

    def of_variant(v: Column) -> Column:
        require = F.try_variant_get(v, "$[0].require", "variant")
        there = F.when(require.isNotNull() & ~F.is_variant_null(require), F.lit(True))
        return F.struct(F.lit(True).alias("ok"), there.alias("req"), v.alias("v"), no_text.alias("text"))

    def of_text(x: Column) -> Column:
        req = x.getField("req")
        return F.struct(x.getField("ok").alias("ok"), F.when(req.isNotNull(), F.lit(True)).alias("req"), no_variant.alias("v"),
                        F.concat(F.lit('{"require":'), req, F.lit("}")).alias("text"))

    return bind(F.try_parse_json(closed(block)), lambda v: F.when(strict_variant(v), of_variant(v)).otherwise(
        bind(_require(block), of_text)))


def embedded_block(html: ColumnOrName, then, marker: str = STORY_MARKER, pattern: str = SJS_BLOCK_PATTERN) -> Column:
    """``then(variant, text)`` of the block that ``embedded_require_document`` takes, else NULL; one of the two is NULL.

    The block itself is a document with a ``require``: its VARIANT goes on as it is, without a text in between.
    """
    return bind(_deciding(_col(html), marker, pattern, _parsed_block),
                lambda x: F.when(x.getField("ok"), then(x.getField("v"), x.getField("text"))))


def embedded_require_document(html: ColumnOrName, marker: str = STORY_MARKER,
                              pattern: str = SJS_BLOCK_PATTERN) -> Column:
    """Q4 core: ``{"require": …}`` from the first qualifying marked block, else NULL.

    Marked blocks are visited in document order. The first one that either
    is not one whole JSON value or has a non-null ``require`` decides: a parse failure
    voids the whole page, otherwise its ``require`` is re-wrapped (P11). Repeated keys
    and ``NaN`` are accepted. Each marked block is parsed once.
    """
    return bind(_deciding(_col(html), marker, pattern, _require),
                lambda x: F.when(x.getField("ok"), F.concat(F.lit('{"require":'), x.getField("req"), F.lit("}"))))


def unwrap_reels_json(doc: ColumnOrName, path: str = REELS_PATH) -> Column:
    """P5: reels list as JSON text; a document whose root is already a list is
    accepted as unwrapped. NULL when the path does not resolve."""
    d = _col(doc)
    return F.coalesce(F.get_json_object(d, path),
                      F.when(F.ltrim(d).startswith("["), d))
