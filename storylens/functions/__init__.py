"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from storylens.functions.strings import (  # noqa: F401
    date_stamp, display_host, profile_key, redirect_host, split_get,
)
from storylens.functions.binary import body_text  # noqa: F401
from storylens.functions.jsonpath import (  # noqa: F401
    REELS_PATH, STORY_MARKER, embedded_require_document, script_blocks, unwrap_reels_json,
)
