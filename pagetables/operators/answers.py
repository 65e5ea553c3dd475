"""Structured answers.

Model calls are not made here: requests are written as a table for a batch
inference job, and its answers come back as a completions table
``(key, kind, content)``.  Parsing is typed JSON/VARIANT on the JVM; a
refusal or malformed answer becomes a status, never an exception.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.operators.content import story_columns, with_defaults
from pagetables.session import sized

# Answer shapes (JSON schemas of the four questions).
DECISION_SCHEMA = "struct<decision: boolean>"
TITLE_ROWS = "array<struct<title: string, url: string>>"
STORY_STRUCT = "struct<title: string, author: string, content: string>"
MESSAGE = T.StructType([T.StructField("role", T.StringType()),
                        T.StructField("content", T.StringType())])


def build_chat_requests(df: DataFrame, prompt, text: str = "text",
                        question: str | None = None, out: str = "messages") -> DataFrame:
    """One request per row: system prompt, the page text, optionally a question.

    ``prompt`` is a string or a Column (e.g. from ``read_prompt`` joined in).
    """
    p = F.lit(prompt) if isinstance(prompt, str) else prompt
    msgs = [F.struct(F.lit("system").alias("role"), p.alias("content")),
            F.struct(F.lit("user").alias("role"), F.col(text).alias("content"))]
    if question is not None:
        msgs.append(F.struct(F.lit("user").alias("role"), F.lit(question).alias("content")))
    return df.withColumn(out, F.array(*msgs))


def collect_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                     role: str = "role", text: str = "text",
                     system_prompt: str | None = None) -> DataFrame:
    """A conversation's turns, in order, as one message array per key.

    One row per key is the nature of a request; a group is one
    conversation (its turns), not a table-wide collection.
    """
    g = turns.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(F.col(order).alias("o"), F.col(role).alias("role"),
                 F.col(text).alias("content")))).alias("_m"))
    msgs = F.transform("_m", lambda s: F.struct(s["role"].alias("role"),
                                                s["content"].alias("content")))
    if system_prompt is not None:
        msgs = F.concat(F.array(F.struct(F.lit("system").alias("role"),
                                         F.lit(system_prompt).alias("content"))), msgs)
    return g.select(key, msgs.alias("messages"))


# What each question's answer must look like, as JSON schemas.
_TEXT = {"type": "string"}
ANSWER_SCHEMAS = {
    "categories": {"type": "object", "properties": {
        "categories": {"type": "object", "additionalProperties": _TEXT}, "error": _TEXT}},
    "decision": {"type": "object", "properties": {"decision": {"type": "boolean"}}, "required": ["decision"]},
    "titles": {"type": "object", "properties": {
        "titles_and_urls": {"type": "object", "additionalProperties": _TEXT}, "next_page": _TEXT, "error": _TEXT}},
    "story": {"type": "object", "properties": {
        "content": {"type": "object", "properties": {"title": _TEXT, "author": _TEXT, "content": _TEXT}},
        "next_page": _TEXT, "error": _TEXT}},
}


# The fields that each answer must have.
REQUIRED = {"categories": {}, "decision": {"": ["decision"]}, "titles": {"": ["titles_and_urls", "next_page"]},
            "story": {"": ["content", "next_page"], "content": ["title", "author", "content"]}}


def strict_schema(kind: str) -> dict:
    """An answer's schema in which nothing is left open: objects of named fields allow no others
    (refusals, ``error``, only where no field is required) and name those that must be there."""
    def closed(s, path):
        if s.get("type") != "object" or "properties" not in s:
            return s
        must = REQUIRED[kind].get(path, [])
        fields = {k: closed(v, f"{path}.{k}".strip(".")) for k, v in s["properties"].items() if not (must and k == "error")}
        return {"type": "object", "properties": fields, **({"required": must} if must else {}), "additionalProperties": False}
    return closed(ANSWER_SCHEMAS[kind], "")


def requests_json(df: DataFrame, messages: str = "messages", kind: str | None = None,
                  model: str | None = None, temperature: float | None = None, strict: bool = False) -> DataFrame:
    """X1 output form: the request body as JSON text (for a batch job's input file).

    ``kind`` adds the answer's schema (``ANSWER_SCHEMAS``; ``strict``: ``strict_schema``) as the
    response format; ``model`` and ``temperature`` are written if given."""
    fields = [F.col(messages).alias("messages")]
    if model is not None:
        fields.append(F.lit(model).alias("model"))
    if kind is not None:
        schema = strict_schema(kind) if strict else ANSWER_SCHEMAS[kind]
        body = {"type": "json_schema", "json_schema": {"name": kind, "schema": schema}}
        fields.append(F.parse_json(F.lit(json.dumps(body))).alias("response_format"))
    if temperature is not None:
        fields.append(F.lit(float(temperature)).alias("temperature"))
    return df.withColumn("request", F.to_json(F.struct(*fields)))


def _last_key_wins(df: DataFrame) -> DataFrame:
    """Answers are read as ``json.loads`` reads them: of duplicate keys, the
    last one wins (Spark's VARIANT parser rejects duplicates unless told)."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def _variant(content: str) -> Column:
    return F.try_parse_json(F.col(content))


def one_answer_each(completions: DataFrame) -> DataFrame:
    """(key, kind, content), written: of several answers of one kind for a key the smallest content.

    Answers are written where they are made.  Their keys alone are shuffled to learn which were
    answered several times; only contents of these are gathered, and all are written anew then."""
    c = sized(completions.select("key", "kind", "content"))
    again = c.groupBy("key", "kind").count().filter("count > 1")
    again = sized(again.select(F.col("key").alias("_key"), F.col("kind").alias("_kind")))
    if again.isEmpty():
        return c
    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("kind").eqNullSafe(F.col("_kind"))
    least = c.join(again, same, "left_semi").groupBy("key", "kind").agg(F.min("content").alias("content"))
    return sized(c.join(again, same, "left_anti").unionByName(least))


def answer_status(content: str = "content") -> Column:
    """X3: 'refused' for ``{"error": …}``, 'bad' for text that is not a JSON object."""
    v = _variant(content)
    err = F.try_variant_get(v, "$.error", "string")
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return (F.when(~is_obj | v.isNull(), F.lit("bad"))
             .when(err.isNotNull(), F.lit("refused"))
             .otherwise(F.lit("ok")))


# How a VARIANT's type is written, by JSON type.
_VARIANT_TYPES = {"object": "^OBJECT<", "array": "^ARRAY<", "string": "^STRING$", "boolean": "^BOOLEAN$",
                  "number": "^(BIGINT|DOUBLE|DECIMAL.*)$"}


def schema_fault(value: Column, schema: dict, path: str | Column = "") -> Column:
    """The path of the first place where a VARIANT does not meet a JSON schema; null if it does.

    Looked at in this order: the type, required fields that are missing, fields that are not
    allowed (by name), then the fields one by one, an open object's values by name and an
    array's items in order.  A path is field names joined by dots, items as ``[i]``; the
    whole answer is ``$``."""
    here = F.lit(path) if isinstance(path, str) else path
    name = F.when(here == "", "$").otherwise(here)

    def at(key: Column) -> Column:
        return F.concat(here, F.when(here == "", "").otherwise("."), key)
    is_type = F.coalesce(F.schema_of_variant(value).rlike(_VARIANT_TYPES[schema["type"]]), F.lit(False))
    faults = []
    if schema["type"] == "object":
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        keys = F.array_sort(F.map_keys(fields))
        props, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        for k in schema.get("required", []):
            faults.append(F.when(~F.array_contains(keys, k), at(F.lit(k))))
        others = F.filter(keys, lambda k: ~k.isin(list(props))) if props else keys
        if more is False:
            faults.append(F.get(F.transform(others, at), F.lit(0)))
        for k, s in props.items():
            inner = F.element_at(fields, F.lit(k))
            faults.append(F.when(F.array_contains(keys, k), schema_fault(inner, s, at(F.lit(k)))))
        if isinstance(more, dict):
            each = F.transform(others, lambda k: schema_fault(F.element_at(fields, k), more, at(k)))
            faults.append(F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0)))
    if schema["type"] == "array" and "items" in schema:
        items = F.try_variant_get(value, "$", "array<variant>")
        each = F.transform(items, lambda x, i: schema_fault(x, schema["items"], F.concat(here, F.lit("["), i.cast("string"), F.lit("]"))))
        faults.append(F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0)))
    return F.when(~is_type, name).otherwise(F.coalesce(*faults) if faults else F.lit(None).cast("string"))


def split_refusals(completions: DataFrame, content: str = "content", kind: str | None = None) -> DataFrame:
    """Tag each answer ok / refused / bad, with the refusal text.

    With ``kind`` (the column that names the question), an answer that is neither refused nor
    bad is held against its ``strict_schema``: ``schema:<path>`` names its first fault."""
    v = _variant(content)
    status = answer_status(content)
    if kind is not None:
        fault = F.lit(None).cast("string")
        for k in ANSWER_SCHEMAS:
            fault = F.when(F.col(kind) == k, schema_fault(v, strict_schema(k))).otherwise(fault)
        status = F.when((status == "ok") & fault.isNotNull(), F.concat(F.lit("schema:"), fault)).otherwise(status)
    return _last_key_wins(completions).withColumn("status", status).withColumn(
        "error", F.try_variant_get(v, "$.error", "string"))


def parse_categories(completions: DataFrame, content: str = "content",
                     key: str = "key") -> DataFrame:
    """``{"categories": {name: url}}`` -> one row (key, category, url) per entry;
    a refusal (``{"error": …}``) or bad JSON gives no row."""
    v = _variant(content)
    cats = F.try_variant_get(v, "$.categories", "map<string,string>")
    ok = _last_key_wins(completions).select(
        key, cats.alias("_c"), F.try_variant_get(v, "$.error", "string").alias("_e"))
    return ok.filter(F.col("_e").isNull()).select(
        key, F.explode("_c").alias("category", "url"))


def parse_decision(completions: DataFrame, content: str = "content",
                   key: str = "key") -> DataFrame:
    """Anything but a JSON boolean ``decision`` counts as false."""
    v = _variant(content)
    d = F.try_variant_get(v, "$.decision", "boolean")
    is_bool = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.decision", "variant"))
                         == F.lit("BOOLEAN"), F.lit(False))
    return _last_key_wins(completions).select(
        key, F.when(is_bool, d).otherwise(F.lit(False)).alias("decision"))


def parse_titles(completions: DataFrame, content: str = "content", key: str = "key") -> DataFrame:
    """``titles_and_urls`` as an array of {title, url} or as a map title -> url,
    plus ``next_page`` -> (key, pos, title, url, next_page); missing fields are ''."""
    base = parse_listing(completions, content, key)
    return base.select(key, "next_page", F.posexplode("rows").alias("pos", "r")).select(
        key, F.col("pos").cast("int").alias("pos"), "r.title", "r.url", "next_page")


def parse_listing(completions: DataFrame, content: str = "content", key: str = "key") -> DataFrame:
    """X2c, one row an answer: (key, rows, next_page), ``rows`` an array of (title, url) in the
    answer's order; a refusal, a bad answer and one without titles have an empty array."""
    v = _variant(content)
    arr = F.try_variant_get(v, "$.titles_and_urls", TITLE_ROWS)
    mp = F.try_variant_get(v, "$.titles_and_urls", "map<string,string>")
    # a map's entries in the answer's order (a VARIANT sorts its keys)
    names = F.array_distinct(F.json_object_keys(F.get_json_object(F.col(content), "$.titles_and_urls")))
    rows = F.coalesce(arr, F.transform(F.coalesce(names, F.map_keys(mp)), lambda k: F.struct(
        k.alias("title"), F.element_at(mp, k).alias("url"))))
    nxt = F.coalesce(F.try_variant_get(v, "$.next_page", "string"), F.lit(""))
    rows = F.transform(F.coalesce(rows, F.array().cast(TITLE_ROWS)), lambda r: F.struct(
        F.coalesce(r["title"], F.lit("")).alias("title"), F.coalesce(r["url"], F.lit("")).alias("url")))
    return _last_key_wins(completions).select(key, rows.alias("rows"), nxt.alias("next_page"))


def parse_story(completions: DataFrame, content: str = "content", key: str = "key") -> DataFrame:
    """X2d: ``{"content": {title, author, content}, "next_page"}``; also the flat form
    ``{title, author, content}``.  -> (key, title, author, content, next_page, status)."""
    v = _variant(content)
    nested = F.try_variant_get(v, "$.content", STORY_STRUCT)
    flat_title = F.try_variant_get(v, "$.title", "string")
    flat_author = F.try_variant_get(v, "$.author", "string")
    flat_content = F.when(nested.isNull(), F.try_variant_get(v, "$.content", "string"))
    out = _last_key_wins(completions).select(
        key,
        F.coalesce(nested["title"], flat_title, F.lit("")).alias("title"),
        F.coalesce(nested["author"], flat_author, F.lit("")).alias("author"),
        F.coalesce(nested["content"], flat_content, F.lit("")).alias("content"),
        F.coalesce(F.try_variant_get(v, "$.next_page", "string"), F.lit("")).alias("next_page"),
        answer_status(content).alias("status"))
    return out


def assemble_stories(links: DataFrame, stories: DataFrame, url: str = "url") -> DataFrame:
    """Story record = link row + parsed answer; blanks where the answer failed.

    links: (title, url, category); stories: parse_story keyed by url.
    -> (title, author, content, category, url) in the K3 order.  Of several good
    answers for a url the smallest (content, author) counts.
    """
    one = F.min(F.struct(F.col("content").alias("c"), F.col("author").alias("a")))
    s = stories.filter(F.col("status") == "ok").groupBy(F.col("key").alias("_k")).agg(one.alias("_s")).select(
        "_k", F.col("_s.a").alias("_author"), F.col("_s.c").alias("_content"))
    j = links.join(s, F.col(url) == F.col("_k"), "left")
    j = with_defaults(j, ["_author", "_content", "category", url])
    return story_columns(j, {"title": "title", "author": "_author", "content": "_content", "category": "category", "url": url})
