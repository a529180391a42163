"""Explicit schemas for every entity (a missing field reads as NULL, never an error).

Inference costs an extra pass over the data and makes the result depend on
which files happen to exist, so every reader here takes one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# A link sticker inside a story. Captured documents carry ``story_link.url``,
# provider exports ``story_link.display_url``; each parse schema names only
# the field it reads, so the JSON parser skips everything else.
def _reel_items(link_field: str) -> T.ArrayType:
    link = T.StructType([T.StructField(link_field, T.StringType())])
    sticker = T.StructType([T.StructField("story_link", link)])
    return T.ArrayType(T.StructType([T.StructField("story_link_stickers", T.ArrayType(sticker))]))


ITEMS = _reel_items("url")

# One element of the reels list.
REEL = T.StructType([
    T.StructField("user", T.StructType([T.StructField("username", T.StringType())])),
    T.StructField("items", ITEMS),
])
REELS = T.ArrayType(REEL)

# One provider export item; ``stories`` is kept as text because it holds
# either a JSON array or a sentence.
EXPORT_ITEM = T.StructType([
    T.StructField("requested", T.StringType()),
    T.StructField("stories", T.StringType()),
])
EXPORT_STORIES = _reel_items("display_url")

# Raw captured documents (K3 output, input of the unwrap step).
RAW_DOCUMENTS = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("username", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("doc", T.StringType()),
])

# Browser performance-log entry; ``message`` is JSON text.
CAPTURE_LOG = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("message", T.StringType()),
])
LOG_MESSAGE = T.StructType([
    T.StructField("message", T.StructType([
        T.StructField("method", T.StringType()),
        T.StructField("params", T.StructType([
            T.StructField("requestId", T.StringType()),
            T.StructField("response", T.StructType([
                T.StructField("url", T.StringType()),
            ])),
        ])),
    ])),
])

# E5: response bodies fetched by request id.
BODIES = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("base64_encoded", T.BooleanType()),
])

# Origin rules.
ORIGIN_RULES = T.StructType([
    T.StructField("host", T.StringType(), False),
    T.StructField("origin", T.StringType(), False),
])

# Published snapshots.
SNAPSHOT = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("date", T.DateType()),
])
LINK_SNAPSHOT = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("story_link_url", T.StringType()),
    T.StructField("origin", T.StringType()),
])

# Capture outcome per profile.
CAPTURE_STATUSES = ("captured", "payload_not_found", "body_error", "not_available", "page_error")
