"""Writers (K1–K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three story layouts and their column order.
STORY_COLUMNS_A = ["name", "url", "category", "content"]
STORY_COLUMNS_B = ["title", "text", "category", "story_url"]
STORY_COLUMNS_C = ["title", "author", "content", "category", "url"]


def write_stories_csv(df: DataFrame, path: str, columns, mode: str = "overwrite",
                      quote_all: bool = False) -> None:
    """K1–K3: CSV with header, no index, fixed column order.

    Written in parallel (one file per partition); embedded commas, quotes and
    newlines are quoted with ``"`` doubled, as Python's csv module does, and
    surrounding whitespace is kept (Spark trims it by default).
    """
    (df.select(*columns).write.mode(mode)
       .option("header", True).option("escape", '"').option("quote", '"')
       .option("quoteAll", quote_all).option("encoding", "UTF-8")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def write_records_csv(df: DataFrame, map_col: str, path: str, key_name: str = "key", mode: str = "overwrite") -> None:
    """K4: a map of records written as CSV, one row a key, the key as the first column (the index
    of ``pd.DataFrame(d).T.to_csv()``).  A field that a record lacks is written empty."""
    r = records_from_map(df, map_col, key_name)
    write_stories_csv(r.na.fill("", [f.name for f in r.schema if f.dataType.simpleString() == "string"]), path, r.columns, mode)


def records_from_map(df: DataFrame, map_col: str, key_name: str = "key", keep=()) -> DataFrame:
    """K4: a map of records (``pd.DataFrame(d).T``) to one row per key, beside the ``keep`` columns."""
    e = df.select(*keep, F.explode(map_col).alias(key_name, "_v"))
    return e.select(*keep, key_name, "_v.*")
