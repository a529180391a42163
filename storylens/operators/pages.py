"""Q4: saved pages -> embedded story documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.functions.jsonpath import REELS_PATH, STORY_MARKER, embedded_block, embedded_require_document, script_blocks
from storylens.operators.unwrap import from_text, from_variant


def page_blocks(pages: DataFrame, html_col: str = "html", pattern: str | None = None,
                keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per script block: ``pos`` (0-based) and ``block``."""
    blocks = script_blocks(html_col) if pattern is None else script_blocks(html_col, pattern)
    return pages.select(*keep, F.posexplode(blocks).alias("pos", "block"))


def page_documents(pages: DataFrame, html_col: str = "html", marker: str = STORY_MARKER,
                   out_col: str = "doc") -> DataFrame:
    """Add the ``{"require": …}`` document of each page (NULL when there is none).

    The document is a one-element generator's input, so a filter on it stays above and
    neither searches nor parses the page again.
    """
    doc = embedded_require_document(F.col(html_col), marker)
    return pages.select(*(c for c in pages.columns if c != out_col), F.explode_outer(F.array(doc)).alias(out_col))


def page_reels(pages: DataFrame, html_col: str = "html", marker: str = STORY_MARKER,
               keep: tuple[str, ...] = ("page_id",), path: str = REELS_PATH) -> DataFrame:
    """Q4 end to end: ``keep…, reels, unwrap_status`` of the pages that have a document.

    A block is parsed once, and the reels are read from that parse.
    """
    def outcome(v: Column, text: Column) -> Column:
        return F.when(v.isNotNull(), from_variant(v, path)).otherwise(from_text(text, path))

    found = pages.select(*keep, F.inline_outer(F.array(embedded_block(F.col(html_col), outcome, marker))))
    return found.filter(F.col("unwrap_status").isNotNull())
