"""response-body text, base64-decoded when flagged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storylens.functions.strings import ColumnOrName, _col

_NOT_BASE64 = "[^A-Za-z0-9+/=]"


def decoded_bytes(body: ColumnOrName) -> Column:
    """Base64 bytes with characters outside the alphabet skipped; NULL if undecodable.

    Unpadded input is accepted (it is an error only in the strict decoder).
    Spark's decoder already skips whitespace and line breaks, so the costly
    regex clean-up runs only for bodies the direct decode rejects.
    """
    b = _col(body)
    b64 = F.lit("base64")
    return F.coalesce(F.try_to_binary(b, b64),
                      F.try_to_binary(F.regexp_replace(b, _NOT_BASE64, ""), b64))


def body_text(body: ColumnOrName, base64_encoded: ColumnOrName) -> Column:
    """Body as text: decoded as UTF-8 when flagged, invalid bytes dropped.

    A missing body reads as ''. When the flag is set and the body cannot be
    decoded the result is NULL (the caller's ``body_error``).
    Invalid UTF-8 is first replaced by U+FFFD and then removed, so a genuine
    U+FFFD in the payload is removed too.
    """
    raw = F.coalesce(_col(body), F.lit(""))
    decoded = F.replace(
        F.make_valid_utf8(decoded_bytes(raw).cast("string")), F.lit("�"), F.lit(""))
    flag = F.coalesce(_col(base64_encoded), F.lit(False))
    return F.when(flag, decoded).otherwise(raw)
