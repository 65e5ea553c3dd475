"""Readers: landed pages, seeds, stories CSV, prompts, completions.

Schemas are explicit everywhere: nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
RAW_PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("body", T.BinaryType()),
    T.StructField("charset", T.StringType()),
])
CATEGORY_SCHEMA = T.StructType([
    T.StructField("category_no", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("url", T.StringType()),
])
COMPLETIONS_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("content", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A landed page table ``(page_id, url, html)``."""
    return spark.read.schema(PAGES_SCHEMA).format(fmt).load(path)


def _decoded(bodies, charsets):
    """Texts and how they were decoded: ``ok``, ``replaced`` (bad bytes became U+FFFD)
    or ``unknown_charset`` (read as UTF-8)."""
    import codecs

    import pandas as pd
    texts, states = [], []
    for body, name in zip(bodies, charsets):
        if body is None:
            texts.append(None)
            states.append(None)
            continue
        try:
            codec, state = codecs.lookup(name or "utf-8"), "ok"
            if not getattr(codec, "_is_text_encoding", True):
                raise LookupError(name)
        except LookupError:
            codec, state = codecs.lookup("utf-8"), "unknown_charset"
        try:
            text = codec.decode(bytes(body))[0]
        except UnicodeDecodeError:
            text = codec.decode(bytes(body), "replace")[0]
            state = "replaced" if state == "ok" else state
        texts.append(text)
        states.append(state)
    return pd.DataFrame({"text": texts, "state": states})


# Byte-order marks, and what two charset labels mean on web pages.
BOMS = [("EFBBBF", "utf-8"), ("FFFE", "utf-16le"), ("FEFF", "utf-16be")]
META_CHARSETS = {"gb2312": "gbk", "iso-8859-1": "cp1252", "utf-16": "utf-8"}
# How far a charset is looked for.
PRESCAN_BYTES = 1024
META_RE = r"(?i)<meta\s[^>]*?charset\s*=\s*[\"']?\s*([a-z0-9_:.-]+)"


def sniff_charset(body: str, charset: str | None = None):
    """The charset of a page's bytes: its byte-order mark, else the declared one, else that of a
    ``<meta charset>`` or ``<meta http-equiv content>`` in its first bytes, else utf-8."""
    head = F.substring(F.col(body), 1, PRESCAN_BYTES)
    start = F.hex(F.substring(F.col(body), 1, 3))
    mark = F.lit(None).cast("string")
    for bom, name in reversed(BOMS):
        mark = F.when(start.startswith(bom), name).otherwise(mark)
    told = F.lower(F.regexp_extract(F.decode(head, "ISO-8859-1"), META_RE, 1))
    known = told
    for label, name in META_CHARSETS.items():
        known = F.when(told == label, name).otherwise(known)
    declared = F.lower(F.trim(F.col(charset))) if charset else F.lit(None).cast("string")
    return F.coalesce(mark, F.when(declared != "", declared), F.when(known != "", known), F.lit("utf-8"))


def decode_pages(df: DataFrame, body: str = "body", charset: str = "charset",
                 out: str = "html", status: str | None = None) -> DataFrame:
    """Bytes + declared charset -> text (``response.encoding = ...``).

    Where no charset is declared the page's own is found (``sniff_charset``); a byte-order
    mark comes before any declaration and does not show in the text.
    UTF-8 is decoded on the JVM; every other
    charset that Python knows in an Arrow-batched stage, which UTF-8 rows pass
    as nulls.  A bad byte becomes U+FFFD and never fails the job; an unknown
    charset is read as UTF-8.  ``status`` names a column that tells ``ok``,
    ``replaced`` and ``unknown_charset`` apart.  No session setting is touched.
    """
    cs = sniff_charset(body, charset if charset in df.columns else None)
    utf8 = cs.isin("utf-8", "utf8")
    start = F.hex(F.substring(F.col(body), 1, 3))
    skip = F.lit(1)
    for bom, _ in reversed(BOMS):
        skip = F.when(start.startswith(bom), 1 + len(bom) // 2).otherwise(skip)
    rest = F.substr(F.col(body), skip, F.octet_length(F.col(body)))
    raw = rest.cast("string")
    udf = F.pandas_udf(_decoded, "text string, state string")
    other, = [n for n in ("_decoded",) if n not in df.columns]
    d = df.withColumn(other, udf(F.when(~utf8, rest), cs))
    d = d.withColumn(out, F.when(utf8, F.make_valid_utf8(raw)).otherwise(F.col(other)["text"]))
    if status:
        d = d.withColumn(status, F.when(utf8 & F.col(body).isNotNull(), F.when(F.is_valid_utf8(raw), "ok").otherwise(
            "replaced")).otherwise(F.col(other)["state"]))
    return d.drop(other)


def category_seeds(spark: SparkSession, mapping) -> DataFrame:
    """S3: ordered ``{category: url}`` literal -> ``categories`` table.

    Insertion order becomes ``category_no`` (order matters for dedup).
    The table is a literal of the driver program: its size is bounded.
    """
    items = list(mapping.items()) if hasattr(mapping, "items") else list(mapping)
    rows = [(i, c, u) for i, (c, u) in enumerate(items)]
    return spark.createDataFrame(rows, CATEGORY_SCHEMA)


def read_stories_csv(spark: SparkSession, path: str, columns,
                     empty_as_null: bool = False) -> DataFrame:
    """Read a stories CSV written by ``write_stories_csv``.

    Story fields are never NULL (missing ones are ''), so by default an
    empty field reads back as '' (Spark would read both ``""`` and an empty
    field as NULL).
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.read
    if not empty_as_null:
        r = r.option("nullValue", "\u0000")
    return (r.schema(schema)
                 .option("header", True).option("multiLine", True)
                 .option("escape", '"').option("quote", '"')
                 .option("ignoreLeadingWhiteSpace", False)
                 .option("ignoreTrailingWhiteSpace", False)
                 .csv(path))


def read_prompt(spark: SparkSession, path: str) -> DataFrame:
    """A prompt file as one row ``(prompt)``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))


def read_completions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Answers produced elsewhere, ``(key, kind, content)``."""
    return spark.read.schema(COMPLETIONS_SCHEMA).format(fmt).load(path)
