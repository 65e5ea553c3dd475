"""The page operators over a stream of landed pages (Structured Streaming)."""

from pagetables.streaming.ingest import (  # noqa: F401
    read_page_stream, story_links, title_table, write_epochs,
)
