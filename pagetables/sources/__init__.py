"""Sources and sinks."""

from pagetables.sources.readers import (  # noqa: F401
    PAGES_SCHEMA, RAW_PAGES_SCHEMA, COMPLETIONS_SCHEMA, CATEGORY_SCHEMA,
    read_pages, decode_pages, category_seeds, read_stories_csv, read_prompt,
    read_completions, read_table,
)
from pagetables.sources.writers import (  # noqa: F401
    STORY_COLUMNS_A, STORY_COLUMNS_B, STORY_COLUMNS_C,
    write_stories_csv, records_from_map,
)
