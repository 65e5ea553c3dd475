"""Structured answers: both shapes, refusals, bad JSON."""

from conftest import rows
from pyspark.sql import functions as F

from pagetables.operators import answers as X


def _c(spark, items):
    return spark.createDataFrame(items, "key string, kind string, content string")


def test_categories_and_refusals(spark):
    c = _c(spark, [("a", "categories", '{"categories": {"Fairy Tales": "u1", "Fables": "u2"}}'),
                   ("b", "categories", '{"error": "Refused: nothing"}'),
                   ("c", "categories", "oops"), ("d", "categories", "{}")])
    assert rows(X.parse_categories(c), "key", "category", "url") == [
        ("a", "Fables", "u2"), ("a", "Fairy Tales", "u1")]
    st = rows(X.split_refusals(c), "key", "status")
    assert st == [("a", "ok"), ("b", "refused"), ("c", "bad"), ("d", "ok")]


def test_decision_only_a_boolean_counts(spark):
    c = _c(spark, [("a", "decision", '{"decision": true}'), ("b", "decision", '{"decision": "yes"}'),
                   ("c", "decision", "{}"), ("d", "decision", '{"decision": false}'),
                   ("e", "decision", "not json")])
    assert rows(X.parse_decision(c), "key", "decision") == [
        ("a", True), ("b", False), ("c", False), ("d", False), ("e", False)]


def test_titles_array_and_map_shapes(spark):
    c = _c(spark, [
        ("a", "titles", '{"titles_and_urls": [{"title": "t", "url": "u"}, {"title": "x"}], '
                        '"next_page": ""}'),
        ("b", "titles", '{"titles_and_urls": {"t2": "u2"}, "next_page": "p2"}'),
        ("c", "titles", '{"error": "Refused: this listing holds no tales to read."}'),
        ("d", "titles", '{"titles_and_urls": {}, "next_page": ""}')])
    got = rows(X.parse_titles(c), "key", "title", "url", "next_page")
    assert got == [("a", "t", "u", ""), ("a", "x", "", ""), ("b", "t2", "u2", "p2")]


def test_story_nested_flat_and_blank_author(spark):
    c = _c(spark, [
        ("a", "story", '{"content": {"title": "t", "author": "", "content": "c"}, "next_page": ""}'),
        ("b", "story", '{"title": "t2", "author": "A", "content": "c2"}'),
        ("c", "story", "{\"error\": \"Refused\"}")])
    got = rows(X.parse_story(c), "key", "title", "author", "content", "status")
    assert got == [("a", "t", "", "c", "ok"), ("b", "t2", "A", "c2", "ok"),
                   ("c", "", "", "", "refused")]
    links = spark.createDataFrame([("t", "a", "cat"), ("z", "zz", "cat")],
                                  "title string, url string, category string")
    out = rows(X.assemble_stories(links, X.parse_story(c)), "title", "author", "content", "url")
    assert out == [("t", "", "c", "a"), ("z", "", "", "zz")]


def test_requests_and_messages(spark):
    df = spark.createDataFrame([(1, "page text")], "id long, text string")
    r = X.requests_json(X.build_chat_requests(df, "SYS", question="Q?")).collect()[0]
    assert [m.role for m in r.messages] == ["system", "user", "user"]
    assert r.request.startswith('{"messages":[{"role":"system","content":"SYS"}')
    turns = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a")],
                                  "conv_id long, turn long, role string, text string")
    m = X.collect_messages(turns).collect()[0].messages
    assert [(x.role, x.content) for x in m] == [("user", "a"), ("assistant", "b")]


def test_duplicate_keys_last_wins_like_json_loads(spark):
    c = _c(spark, [("a", "categories", '{"categories": {"x": "1", "x": "2", "y": "3"}}'),
                   ("b", "titles", '{"titles_and_urls": {"t": "u1", "t": "u2"}, "next_page": ""}'),
                   ("c", "decision", '{"decision": false, "decision": true}')])
    assert rows(X.parse_categories(c.filter("kind = 'categories'")), "category", "url") == \
        [("x", "2"), ("y", "3")]
    assert rows(X.parse_titles(c.filter("kind = 'titles'")), "title", "url") == [("t", "u2")]
    assert rows(X.parse_decision(c.filter("kind = 'decision'")), "decision") == [(True,)]


def test_first_fault_of_an_answer(spark):
    import json

    def check(kind, answer):
        c = spark.createDataFrame([(kind, answer if isinstance(answer, str) else json.dumps(answer))], "kind string, content string")
        return X.split_refusals(c, kind="kind").first().status
    story = {"content": {"title": "t", "author": "", "content": "c"}, "next_page": ""}
    assert check("story", story) == "ok"
    assert check("story", {**story, "z": 1, "more": 2}) == "schema:more"
    assert check("story", {"content": story["content"]}) == "schema:next_page"
    assert check("story", {**story, "next_page": None}) == "schema:next_page"
    assert check("story", {**story, "content": {"title": "t", "content": 3}}) == "schema:content.author"
    assert check("story", {**story, "content": {**story["content"], "content": 3}}) == "schema:content.content"
    assert check("story", {**story, "content": []}) == "schema:content"
    assert check("titles", {"titles_and_urls": {"b": [], "a": 1, "c": "u"}, "next_page": ""}) == "schema:titles_and_urls.a"
    assert check("titles", {"titles_and_urls": {}, "next_page": "x"}) == "ok"
    assert check("decision", {"decision": "yes"}) == "schema:decision" and check("decision", {}) == "schema:decision"
    assert check("decision", [1]) == check("decision", "oops") == "bad"
    assert check("categories", {"error": "none"}) == "refused" and check("categories", {"categories": {"a": "u"}}) == "ok"


def test_faults_in_arrays_and_at_the_top(spark):
    schema = {"type": "array", "items": {"type": "object", "properties": {"n": {"type": "number"}}, "required": ["n"]}}
    df = spark.createDataFrame([("[{\"n\": 1}, {\"n\": 2.5}]",), ("[{\"n\": 1}, {\"m\": 1}, 3]",), ("[1]",), ("{}",), ("[]",)], "t string")
    got = [r[0] for r in df.select(X.schema_fault(F.try_parse_json("t"), schema)).collect()]
    assert got == [None, "[1].n", "[0]", "$", None]


def test_answers_of_texts_without_words(spark):
    """A text without titles is answered like any other; a category has a name, and one name is one entry."""
    from pagetables.plans import catalog_site as S
    from pagetables.plans.pipelines import story_table_from_answers
    d = [(1, "", "en", "s"), (2, " \n\t", "es", "s"), (3, None, "fr", "s"), (4, "One tale\n\nTwo", "en", "en"), (5, "Three", None, "s"),
         (6, "Four", "en", None)]
    docs = spark.createDataFrame(d, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    c = S.completions(docs, labels).cache()
    url = (S.STORY_HOST + "story/{}/{}").format
    st = X.parse_story(c.filter("kind = 'story'"))
    assert rows(st, "key", "title", "author", "content", "status") == [
        (url(1, 0), "", "s", "", "ok"), (url(2, 0), "", "s", " \n\t", "ok"), (url(3, 0), "", "s", "", "ok"),
        (url(4, 0), "One", "en", "One tale\n\nTwo", "ok"), (url(5, 0), "Three", "s", "Three", "ok"), (url(6, 0), "Four", "", "Four", "ok")]
    cats = rows(X.parse_categories(c.filter("kind = 'categories'")), "key", "category")
    assert cats == sorted((f"{S.STORY_HOST}home/{i}", n) for i, _, *names in d for n in {*names} - {None})
    assert rows(story_table_from_answers(c), "title", "author", "category", "url") == [
        ("Four", "", "en", url(6, 0)), ("One", "en", "en", url(4, 0)), ("Two", "", "en", url(4, 2))]
    c.unpersist()


def test_only_contents_answered_again_are_gathered(spark):
    c = [("a", "story", "2"), ("b", "story", "1"), ("a", "titles", "3"), (None, "story", "5"), (None, "titles", None)]
    schema = "key string, kind string, content string"
    once = X.one_answer_each(spark.createDataFrame(c, schema))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(c, key=repr)
    again = X.one_answer_each(spark.createDataFrame([*c, ("a", "story", "1"), (None, "story", "4"), ("b", "story", None)], schema))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(
        [("a", "story", "1"), ("b", "story", "1"), ("a", "titles", "3"), (None, "story", "4"), (None, "titles", None)], key=repr)


def test_story_csv_of_texts_without_words(spark, tmp_path):
    import __spark_entry__ as E
    docs = [(1, "", "en", "s"), (2, " \n\t", "es", "s"), (3, None, "fr", "s"), (4, 'One "tale",\r\n\nTwo', "en", "t")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = E.queries()["story_csv_from_answers"](spark, str(tmp_path))
    url = "http://stories.example/story/4/{}".format
    assert rows(got, "title", "author", "content", "category", "url") == [
        ("One", "t", 'One "tale",\r\n\nTwo', "en", url(0)), ("Two", "", "", "en", url(2))]
