"""Pages land over time (a crawler writes files as it goes); the title table
is kept up to date as they arrive.

The stateless part (anchor extraction, prefix filter, stop list) is the
batch operators unchanged.  The last-wins title table is a streaming
aggregation keyed by title (``max_by`` over the order struct), so its state
is one row per distinct title; partial aggregation runs before the state
store shuffle.  Each micro-batch's changed rows are written under their
epoch id, overwriting on retry, so the sink is idempotent; readers take the
latest epoch per title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.text import url_origin, url_path_segment
from pagetables.operators.html import extract_anchors
from pagetables.operators.links import drop_ignored_titles, links_with_prefix
from pagetables.session import scratch_path
from pagetables.sources.readers import PAGES_SCHEMA


def read_page_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(PAGES_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def story_links(pages: DataFrame, prefix: str = "/", ignore=()) -> DataFrame:
    """H2 -> F1 -> F4 -> F9 on a stream (or a batch): (title, url, category, page_id, elem_seq)."""
    a = extract_anchors(pages)
    a = links_with_prefix(a, prefix).withColumn("title", F.col("text"))
    a = drop_ignored_titles(a, list(ignore))
    return a.select("title",
                    F.concat(url_origin("url"), F.col("href")).alias("story_url"),
                    url_path_segment("url", 1).alias("category"), "page_id", "elem_seq")


def title_table(links: DataFrame) -> DataFrame:
    """A2 as a streaming aggregation: last write by (page_id, elem_seq) wins."""
    o = F.struct("page_id", "elem_seq")
    return links.groupBy("title").agg(
        F.max_by(F.struct("story_url", "category"), o).alias("v"),
        F.max(o).alias("last_ord"), F.min(o).alias("first_ord")) \
        .select("title", "v.story_url", "v.category", "first_ord", "last_ord")


def write_epochs(df: DataFrame, out: str, checkpoint: str | None = None,
                 available_now: bool = True):
    """Update-mode query writing each epoch's changed rows to ``out/epoch=<id>``."""
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, "title-table-ckpt")

    def sink(batch: DataFrame, epoch_id: int):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    w = df.writeStream.outputMode("update").option("checkpointLocation", ckpt).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_titles(spark: SparkSession, out: str) -> DataFrame:
    """The current title table from the epoch files (latest epoch per title)."""
    t = spark.read.parquet(out)
    return (t.groupBy("title")
             .agg(F.max_by(F.struct("story_url", "category", "first_ord"), "epoch").alias("v"))
             .select("title", "v.story_url", "v.category", "v.first_ord"))
