"""Writers (K1-K6)."""

from storylens.sinks.writers import (  # noqa: F401
    Published, append_per_key, publish_snapshot, read_per_key, route_by_story, snapshot_path, write_latest_documents,
    write_reels_table, write_snapshot,
)
