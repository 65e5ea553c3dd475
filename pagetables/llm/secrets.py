"""Secret scan over an incremental blob ledger (operator 8, native).

Every version of a document is addressed by the SHA-256 of its whole text.
The ledger holds one row per (blob, rule version) that was scanned, with its
findings; only pairs that the ledger lacks are scanned, once per distinct
text, and findings are joined back to every path that holds the blob.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.tables import spare, split, stored

# Fixed values: (kind, pattern, group that must be long enough, its least length).
# The first three are the base kinds; the others are this scanner's own.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
RULES = [
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),          # = runs of [0-9a-f]+ of 24 and more
    # a key block up to its END line; without one, its header and the lines of base64 after it
    ("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[A-Za-z0-9+/=:,\x20\t\r\n-]*?-----END [A-Z ]{0,30}PRIVATE KEY-----"
            r"|(?:[\x20\t\r\n]+[A-Za-z0-9+/=]{16,})*+)", 0, 20),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 35),
]
#: A text without this literal holds no match of the kind (spares a regex pass).
LITERAL = {"access": "AKIA", "pem": "-----BEGIN ", "github": "gh", "jwt": "eyJ"}
BASE = 3
VERSION = "1"
SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _spans(text: Column, k: int) -> Column:
    """Spans of rule ``k``, leftmost and non-overlapping, in code points.

    The gaps that ``split`` leaves and the matches alternate, so a running sum
    of their lengths gives the offsets."""
    name, pattern, group, least = RULES[k]
    p = F.lit(pattern)
    hit = text.rlike(pattern)
    if name in LITERAL:
        hit = text.contains(LITERAL[name]) & hit
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, p, F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, p, F.lit(group)).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        stop = begin + F.coalesce(F.length(x["all"]), F.lit(0))
        one = F.array(F.struct(begin.alias("start"), F.lit(k).alias("kind"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(F.length(x["value"]) >= least, F.concat(acc["out"], one))
                        .otherwise(acc["out"]).alias("out"))
    return F.when(hit, F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPANS))


def blobs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(path, blob)`` of every row; a null text is an empty one."""
    return docs.select(F.col(id_col).alias("path"),
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("blob"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, version: str = VERSION,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger rows that these documents add: ``(blob, version, spans)``.

    ``spans`` holds every finding by start, then kind (empty for a clean text).
    Pairs (blob, version) in ``ledger`` are not scanned again.  Of equal texts
    one is scanned.  Null texts count as empty, null ids and repeated rows are
    allowed, extra columns are ignored, no rows give no rows.
    """
    src = docs.select(F.col(id_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    held = src.groupBy("blob").agg(F.min("path").alias("path"), F.count("*").alias("rows"))
    unseen, known = held, held.filter("rows > 1").select("blob")
    if ledger is not None:
        seen = ledger.filter(F.col("version") == version).select("blob")
        unseen, known = unseen.join(seen, "blob", "left_anti"), known.unionByName(seen)
    # a text of its own that no ledger knows is scanned where it lies; of texts that several paths
    # hold, one row is picked by (blob, path), so that a text held by a third of all is spread over tasks
    known = stored(known, "known")
    shared, alone = split(src, F.col("blob"), known)
    u, _ = split(unseen.select("blob", "path"), F.col("blob"), known)
    u = u.select(F.col("blob").alias("b"), F.col("path").alias("p"))
    texts = alone.unionByName(shared.join(u, (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("p")), "left_semi"))
    each = [_spans(F.col("text"), k) for k in range(len(RULES))]
    found = texts.select("blob", F.array_sort(F.concat(*each)).alias("spans"))
    return found.groupBy("blob").agg(F.max("spans").alias("spans")).select(
        "blob", F.lit(version).alias("version"), "spans")


def findings(docs: DataFrame, ledger: DataFrame, version: str = VERSION,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(path, blob, spans)``: what the ledger says of every path."""
    hits = ledger.filter((F.col("version") == version) & (F.size("spans") > 0)).select("blob", "spans")
    return blobs(docs, id_col, text_col).join(hits, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, ledger: DataFrame, version: str = VERSION, mark: str = "[SECRET]",
           text_col: str = "text") -> DataFrame:
    """``docs`` with every finding replaced by ``mark`` (findings that touch or overlap by one).

    Rows without a finding stay as they are, null texts too, and are not shuffled; repeated
    rows and null ids are told apart by their text alone; other columns are kept, whatever
    their names; no rows give no rows.  Long texts are rewritten whole.
    """
    blob, spans, whole = spare(docs, "blob", "spans", "whole")
    hits = ledger.filter((F.col("version") == version) & (F.size("spans") > 0)).select(
        F.col("blob").alias(blob), F.col("spans").alias(spans))
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        # a finding that begins inside the last one only moves its end
        apart = (acc["at"] == 0) | (s["start"] > acc["at"])
        piece = F.substr(F.col(whole), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(s["stop"], acc["at"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], piece, F.lit(mark))).otherwise(acc["out"]).alias("out"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substr(F.col(whole), acc["at"] + 1, F.length(whole))))
    hits = stored(hits, "hits")
    some, clean = split(docs.withColumn(blob, F.sha2(text.cast("binary"), 256)), F.col(blob), hits.select(blob))
    some = some.join(hits, blob, "left").withColumn(whole, text)
    out = some.withColumn(text_col, F.when(F.col(spans).isNotNull(), done).otherwise(F.col(text_col)))
    return out.select(*docs.columns).unionByName(clean.select(*docs.columns))


def secret_scan(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans and all spans."""
    new = stored(scan(docs, ledger), "ledger")
    every = new if ledger is None else new.unionByName(ledger)
    f = findings(docs, every)
    base = F.filter("spans", lambda s: s["kind"] < BASE)

    def count_of(k):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{RULES[k][0]}")
    count = [count_of(k) for k in range(BASE)]
    return f.select(F.col("path").alias("doc_id"), *count,
                    F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
