"""Readers (S1-S7). Every reader takes an explicit schema."""

from storylens.sources.readers import (  # noqa: F401
    json_values, read_capture_log, read_export_items, read_link_snapshot, read_pages, read_raw_documents,
    read_reels_files, read_roster, read_snapshot, tagged_export_files, tagged_reels_files,
)
