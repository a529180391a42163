"""String functions: literal split with NULL-safe indexing, hosts, profile keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quote_regex(literal: str) -> str:
    """Java-regex quoting of a literal separator (Spark's ``split`` takes a regex)."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_get(c: ColumnOrName, sep: str, n: int) -> Column:
    """``n``-th piece (1-based) of ``c`` split on the literal ``sep``.

    Out of range or NULL input gives NULL; trailing empty pieces are kept.
    ``get`` is used because ``split(...)[i]`` raises in ANSI mode.
    """
    if n < 1:
        raise ValueError("split_get is 1-based")
    return F.get(F.split(_col(c), _quote_regex(sep), -1), F.lit(n - 1))


def redirect_host(url: ColumnOrName) -> Column:
    """destination host of a redirect link.

    Second piece after the literal ``u=``, third piece of that on the literal
    upper-case ``%2F``, then every ``www.`` removed. Lower-case escapes,
    missing ``u=`` and NULL give NULL; a host with no path keeps its tail.
    """
    return F.replace(split_get(split_get(url, "u=", 2), "%2F", 3), F.lit("www."), F.lit(""))


def display_host(display_url: ColumnOrName) -> Column:
    """first ``/`` segment of a scheme-less display url (``www.`` kept)."""
    return split_get(display_url, "/", 1)


def profile_key(link: ColumnOrName) -> Column:
    """profile key = 0-based element 3 of the link split on ``/``.

    The link is compared as text; a shorter link or NULL gives NULL, which
    callers route to quarantine. A query string stays part of the key.
    """
    return F.get(F.split(_col(link).cast("string"), "/", -1), F.lit(3))


def date_stamp(d: ColumnOrName) -> Column:
    """``yyyyMMdd`` text of a date."""
    return F.date_format(_col(d), "yyyyMMdd")
