import hashlib
import json
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from stockpot.operators import indexes as I
from stockpot.operators import search as S
from stockpot.operators.edit import changed_fields, edit_stats, merge_ids, rename_id, repair
from stockpot.operators.replies import ask, choice_content, improve, merge_state, parsed_reply, request_payload, route, work_through
from stockpot.operators.validate import require_valid, split_valid, violations
from stockpot.plans.catalog import build_catalog, next_sequence
from stockpot.queries_catalog import QUERIES
from stockpot.sources import documents as D
from stockpot.sources.documents import dump_rows, read_documents, read_hashes, read_url_list
from stockpot.sources.fetch import crawl, fetch_pages, store_images
from stockpot.streaming.manifests import CHANGE, apply_changes, follow, read_changes, read_state

DOC = (
    "path string, slug string, name string, recipe_type string, brief_description string, cuisine string, image_url string, difficulty string, servings int, cooking_time_minutes int, preparation_time_minutes int, "
    "rest_time_minutes int, dietary_labels array<string>, allergens array<string>, instructions array<struct<position:int,text:string>>, "
    "ingredients array<struct<ingredient_id:string,name:string,normalized_name:string,quantity:string,unit:string,preparation:string,position:int>>, "
    "categories array<struct<id:string,slug:string,name:string>>, tags array<struct<id:string,slug:string,name:string,color:string>>, updated_at bigint, revision int"
)


def _item(name, position=1):
    return ("x", name, name, "1", "cup", None, position)


def _doc(path, slug, ingredients, categories, tags, updated=100):
    return (path, slug, slug.title(), None, None, None, None, "easy", 4, 10, None, 5, [], [], [(1, "do")], ingredients, categories, tags, updated, 1)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        _doc("a.json", "one", [_item("eggs"), _item("egg", 2), _item("salt and pepper", 3)], [("i", "soup", "Old")], [("i", "t", "T", "#1")]),
        _doc("b.json", "two", [_item("egg"), None], [("i", "soup", "New"), None], None, 200),
        _doc("c.json", "three", None, [], []),
    ]
    return spark.createDataFrame(rows, DOC)


def test_occurrences_count_and_the_last_wins(docs):
    assert [(r.slug, r.name, r.recipe_count) for r in I.category_index(docs, "path").collect()] == [("soup", "New", 2)]
    assert {r.normalized_name: r.recipe_count for r in I.ingredient_index(docs, "path").collect()} == {"eggs": 1, "egg": 2, "salt and pepper": 1}
    assert I.tag_index(docs.limit(0), "path").count() == 0


def test_summaries_and_stats(docs):
    rows = {r.slug: r for r in I.recipe_summaries(docs).collect()}
    assert rows["one"].total_time_minutes == 15 and rows["one"].ingredient_names == ["eggs", "egg", "salt and pepper"]
    assert rows["two"].category_slugs == ["soup"] and rows["two"].tag_slugs == [] and rows["three"].ingredient_names == []
    stats = I.catalog_stats(I.recipe_summaries(docs)).first()
    assert (stats.recipes, stats.average_minutes, stats.categories, stats.tags, stats.ingredients) == (3, 15, 1, 1, 3)
    assert I.generated_at(docs, "never").first()[0] == "1970-01-01T00:03:20Z" and I.generated_at(docs.limit(0), "never").first()[0] == "never"


def test_first_and_numbering(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string")
    assert {tuple(r) for r in I.first_of(rows, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 1, None)}
    one = spark.createDataFrame([([(9, "a"), None, (9, "b")],)], "v array<struct<p:int,n:string>>")
    assert [tuple(x) for x in one.select(I.renumbered(F.col("v"), "p")).first()[0]] == [(1, "a"), (2, "b")]


def test_orders(spark):
    rows = spark.createDataFrame([("b", "2"), ("A", "3"), ("a", "1"), ("É", "4")], "name string, slug string")
    assert [r.slug for r in I.in_index_order(rows).collect()] == ["1", "3", "2", "4"]
    assert [r.slug for r in I.in_locale_order(rows).collect()][-1] == "4"
    counts = spark.createDataFrame([("x", 1), ("b", 3), ("a", 3), ("c", 9)], "k string, recipe_count long")
    assert [r.k for r in I.top(counts, "k", 2).collect()] == ["c", "a"]


def test_every_entry_has_its_place_in_index_order(spark, tmp_path):
    rows = [(i, 1, f"{'aBcD'[i % 4]} {i % 7}", f"s{i % 90}") for i in range(300)]
    spark.createDataFrame([*rows, (5, 0, "zz", "old")], "recipe_no long, revision int, name string, slug string").repartition(5).write.parquet(f"{tmp_path}/recipe_summary.parquet")
    want = [r[0] for r in sorted(rows, key=lambda r: (r[2].lower(), r[3], r[0]))]
    got = QUERIES["index_order"](spark, str(tmp_path)).orderBy("place").collect()
    assert [(r.recipe_no, r.place) for r in got] == [(no, i + 1) for i, no in enumerate(want)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parted = I.index_places(spark.createDataFrame(rows, "recipe_no long, revision int, name string, slug string"), "recipe_no")
        assert [r.recipe_no for r in parted.orderBy("place").collect()] == want and parted.where("place = 300").count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert I.index_places(spark.createDataFrame(rows, "recipe_no long, revision int, name string, slug string").limit(0), "recipe_no").count() == 0


def _plural(quantity):
    text = " ".join((quantity or "").lower().split())
    if text in ("", "a", "an", "one"):
        return False
    if m := re.fullmatch(r"(?:(\d+) )?(\d+)/(\d+)", text):
        return int(m[3]) != 0 and int(m[1] or 0) + Fraction(int(m[2]), int(m[3])) > 1
    m = re.search(r"\d+(?:\.\d+)?", text)
    return bool(m) and float(m[0]) > 1


def test_plurals_of_all_lines(spark, tmp_path):
    quantities = [None, "", "a", " An ", "one", "ONE", "1", "2", "1.5", "1/2", "3/2", "1 1/2", "0 1/2", "2/2", "1 0/3", "1 - 1/2", "3/4 to 2", "two", "some", "10-12"]
    rows = list(enumerate(quantities)) * 2
    spark.createDataFrame(rows, "line_id long, quantity string").write.parquet(f"{tmp_path}/ingredient_line.parquet")
    got = [tuple(r) for r in QUERIES["plural_quantities"](spark, str(tmp_path)).orderBy("line_id").collect()]
    assert got == [(i, q, _plural(q)) for i, q in enumerate(quantities)]


def test_search(docs):
    rows = I.recipe_summaries(docs)
    slugs = lambda **f: {r.slug for r in S.search(rows, **f).collect()}
    assert slugs() == {"one", "two", "three"} and slugs(query=" PEPPER ") == {"one"} and slugs(category="soup", tag="t") == {"one"} and slugs(difficulty="hard") == set()
    assert tuple(S.visible(rows, category="soup").first()) == (2, 3)


def test_joins_and_sync(spark):
    index = spark.createDataFrame([("1", "b", "s1"), ("2", "a", "s2"), ("3", "c", "s3")], "id string, name string, slug string")
    named = spark.createDataFrame([("1", ["3", "2", "2", "9"]), ("2", None)], "id string, related_recipe_ids array<string>")
    assert [tuple(r) for r in S.related(named, index, 1).collect()] == [("1", "2", 1)]
    pages = spark.createDataFrame([("s1", 1, "x"), ("s1", 2, "y"), ("s9", 1, "z")], "slug string, n int, name string")
    assert [(r.slug, r.name, r.doc_name) for r in S.slug_join(index, pages, "n").collect()] == [("s1", "b", "y")]
    here = spark.createDataFrame([("1", "a"), ("2", None), ("3", "c"), ("4", "d")], "id string, digest string")
    there = spark.createDataFrame([("1", "a"), ("2", None), ("3", "x"), ("5", "e")], "id string, digest string")
    assert {tuple(r) for r in S.sync_diff(here, there).collect()} == {("3", "fetch"), ("4", "remove"), ("5", "fetch")}
    assert S.next_item(index, here.limit(1), "id", "slug").first().id == "2"


SCHEMA = {
    "properties": {
        "kind": {"type": ["string", "null"], "enum": ["a", None]},
        "n": {"type": "integer", "minimum": 1},
        "tags": {"type": "array", "items": {"type": "string", "minLength": 2}},
        "inner": {"$ref": "#/$defs/inner"},
    },
    "required": ["n"],
    "additionalProperties": False,
    "$defs": {"inner": {"type": ["object", "null"], "properties": {"hash": {"type": "string", "pattern": "^[a-f]+$"}}, "required": ["hash"]}},
}


def test_validation(spark):
    rows = spark.createDataFrame([("a", 1, ["xx"], ("abc",)), ("condiment", 0, ["x", None], ("XYZ",)), (None, None, None, None), ("a", 1, [], (None,))], "kind string, n int, tags array<string>, inner struct<hash:string>")
    got = [list(r[0]) for r in rows.select(violations(rows, SCHEMA)).collect()]
    assert got[0] == [] and got[2] == ["n: is not of type integer"] and got[3] == ["inner.hash: is not of type string"]
    assert [g.partition(":")[0] for g in got[1]] == ["inner.hash", "kind", "n", "tags.0", "tags.1"]
    good, bad = split_valid(rows, SCHEMA, 2)
    assert good.count() == 1 and all(len(r.errors) <= 2 for r in bad.collect())
    assert require_valid(good, SCHEMA).count() == 1
    with pytest.raises(Exception, match="schema validation failed"):
        require_valid(rows, SCHEMA).collect()
    with pytest.raises(ValueError, match="extra"):
        violations(rows.withColumn("extra", F.lit(1)), SCHEMA)


def test_merge_and_rename(spark, docs):
    items = [("1", "Eggs", "eggs"), ("2", "egg", "egg"), ("3", "salt", "salt")]
    kind = "rec string, ingredients array<struct<ingredient_id:string,name:string,normalized_name:string,position:int>>"
    rows = spark.createDataFrame([("a", [(*i, n) for n, i in enumerate(items)]), ("b", [(*items[2], 1)])], kind)
    index = spark.createDataFrame(items, "id string, name string, normalized_name string")
    merged = merge_ids(rows, index, ["1", "2", "1"])
    assert [tuple(x) for x in merged.first().ingredients] == [("1", "eggs", "eggs", 0), ("1", "eggs", "eggs", 1), ("3", "salt", "salt", 2)]
    assert tuple(edit_stats(merged).first()) == (1, 2)
    with pytest.raises(ValueError, match="unknown"):
        merge_ids(rows, index, ["1", "9"])
    with pytest.raises(ValueError, match="two"):
        merge_ids(rows, index, ["1", "1"])
    renamed = rename_id(rows, index, "3", "A Pinch of Salt!")
    assert renamed.count() == 2 and {x.name for r in renamed.collect() for x in r.ingredients} >= {"a pinch of salt"}
    with pytest.raises(ValueError, match="empty"):
        rename_id(rows, index, "3", "!!")


REPAIR = "rec_no long, id string, slug string, schema_version int, updated_at long, revision int, difficulty string, categories array<struct<id:string,slug:string,name:string>>, tags array<struct<id:string,slug:string,name:string>>, ingredients array<struct<name:string,normalized_name:string,quantity:string,unit:string,preparation:string>>"


def test_repair(spark):
    tag = ("1", "t", "T")
    old = spark.createDataFrame([(1, "id", "s", 1, 5, 2, "easy", [], [tag], [])], REPAIR)
    new = spark.createDataFrame([(1, "other", "s", 1, 6, 2, "intermediate", [tag], [("", "spicy", None)], [("garlic, minced", "garlic", "3", " ", None), ("bay leaf", "bay leaf", "2", None, None), ("water spinach", "water spinach", "1", "", None)])], REPAIR)
    r = repair(old, new).first()
    assert (r.id, r.updated_at, r.difficulty) == ("id", 5, "medium") and [tuple(c) for c in r.categories] == [tag] == [tuple(c) for c in r.tags]
    assert [(i.unit, i.preparation) for i in r.ingredients] == [("cloves", "minced"), ("pieces", None), ("piece", None)]
    assert "restored immutable field id" in r.repairs and "filled preparation for ingredient 'garlic, minced'" in r.repairs and "normalized difficulty from 'intermediate' to 'medium'" in r.repairs
    assert changed_fields(old, new, "rec_no").first().changed == "categories, difficulty, ingredients, tags"
    assert changed_fields(old, old, "rec_no").first().changed == "no visible changes"


def test_replies(values, spark):
    content = [
        {"message": {"content": "x"}}, {"message": {"content": [" a ", {"text": "b"}, {"text": {"value": "c"}}, {"n": 1}]}}, {"text": "z"}, {"message": {"content": " "}}, {},
    ]
    assert values(lambda v: choice_content(F.col(v)), *map(json.dumps, content), "broken", None) == ["x", "a\nb\nc", "z", "", "", "", ""]
    replies = ['```json\n{"recipe": {"a": 1}, "summary": "s"}\n```', '{"recipe": {}} and more', "nonsense", "[1]", '{"recipe": 3}']
    got = values(lambda v: parsed_reply(F.col(v)), *replies)
    assert (got[0].recipe, got[0].summary, got[0].error) == ('{"a":1}', "s", None) and got[1].error is None
    assert [g.error is not None for g in got[2:]] == [True, True, True]
    payload = spark.createDataFrame([('{"a": 1}', None), ("{}", "bad")], "d string, e string").select(request_payload(F.col("d"), "m", "do", F.col("e"))).collect()
    assert [json.loads(p[0])["messages"][1]["content"] for p in payload] == ['{"a": 1}', "Validation error:\nbad\n\nCurrent candidate:\n{}"] and json.loads(payload[0][0])["response_format"] == {"type": "json_object"}
    requests = spark.createDataFrame([("1", "good"), ("2", "empty")], "id string, payload string")
    asked = ask(requests, lambda p: "ok" if p == "good" else " ", "id")
    assert {tuple(r) for r in asked.collect()} == {("1", "ok", 1), ("2", " ", 2)}
    rows = spark.createDataFrame([([], False), (["e"], False), (["e"], True)], "e array<string>, r boolean")
    assert [r.route for r in route(rows, F.col("e"), F.col("r")).collect()] == ["valid", "retry", "manual"]
    state = spark.createDataFrame([("a", 1), ("b", 2)], "id string, seq int")
    assert {tuple(r) for r in merge_state(state, spark.createDataFrame([("a", 5), ("c", 6)], "id string, seq int")).collect()} == {("a", 1), ("b", 2), ("c", 6)}


def test_improving_asks_twice_and_then_leaves_it_to_people(spark):
    docs = spark.createDataFrame([(i, json.dumps({"name": i})) for i in ("good", "late", "never", "broken")], "id string, document string")

    def call(payload):
        told = json.loads(payload)["messages"][1]["content"]
        name = next(n for n in ("good", "late", "never", "broken") if n in told)
        if name == "broken":
            return "{"
        return json.dumps({"recipe": {"name": name, "ok": name == "good" or name == "late" and "Validation error" in told}, "summary": "s"})

    def check(rows):
        return rows.select("id", F.when(~F.get_json_object("recipe", "$.ok").cast("boolean"), F.array(F.lit("not ok"))).otherwise(F.array().cast("array<string>")).alias("errors"))

    got = {r.id: (r.route, r.errors) for r in improve(docs, call, "m", "do", check).collect()}
    assert got == {"good": ("valid", []), "late": ("valid", []), "never": ("manual", ["not ok"]), "broken": ("manual", ["model output was not valid JSON"])}


def test_build_catalog(spark, docs, tmp_path):
    release = build_catalog(docs, str(tmp_path), bump=True)
    assert json.loads((tmp_path / "release.json").read_text()) == release and release["repo_sequence"] == 2
    for part in [*release["indexes"].values(), release["latest_manifest"]]:
        assert hashlib.sha256((tmp_path / part["path"]).read_bytes()).hexdigest() == part["sha256"]
    index = json.loads((tmp_path / "indexes/ingredients.index.json").read_text())
    assert [(i["normalized_name"], i["recipe_count"]) for i in index["ingredients"]] == [("egg", 3), ("pepper", 1), ("salt", 1)] and index["generated_at"] == "1970-01-01T00:03:20Z"
    review = json.loads((tmp_path / "indexes/ingredients.review.json").read_text())["entries"]
    assert [(e["recipe_slug"], e["resolution"]) for e in review] == [("one", "split")]
    manifest = json.loads((tmp_path / "manifests/0000000002.json").read_text())
    assert [u["slug"] for u in manifest["upserts"]] == ["one", "three", "two"] and manifest["removals"] == [] and manifest["from_sequence"] == 1
    assert next_sequence(release, False) == 2 and next_sequence(None, True) == 2
    assert (release["minimum_supported_client_version"], release["catalog_version"], release["$schema"]) == ("1.0.0", "v1", "./schemas/release.schema.json")
    assert list(manifest) == ["$schema", "schema_version", "from_sequence", "to_sequence", "generated_at", "upserts", "removals"] and index["$schema"] == "../schemas/ingredients-index.schema.json"
    with pytest.raises(ValueError, match="no documents"):
        build_catalog(docs.limit(0), str(tmp_path))
    # what is written can be read, and a second build goes on from the first
    back = {name: D.read_index(spark, f"{tmp_path}/indexes/{name}.index.json", name) for name in ("recipes", "categories", "tags", "ingredients")}
    assert [r.slug for r in back["recipes"].collect()] == ["one", "three", "two"] and back["categories"].first().recipe_count == 2 and {r.id for r in D.read_ingredient_index(spark, f"{tmp_path}/indexes/ingredients.index.json").collect()} == {i["id"] for i in index["ingredients"]}
    again = build_catalog(docs, str(tmp_path), tables=str(tmp_path / "tables"))
    assert again == release and spark.read.parquet(f"{tmp_path}/tables/recipes").count() == 3
    for missing in (lambda: D.read_index(spark, f"{tmp_path}/none.json", "tags"), lambda: D.read_ingredient_index(spark, f"{tmp_path}/none.json")):
        with pytest.raises(FileNotFoundError, match="none.json"):
            missing()


def test_build_checks_by_schemas(spark, docs, tmp_path):
    folder = tmp_path / "schemas"
    folder.mkdir()
    put = lambda name, schema: (folder / name).write_text(json.dumps(schema))
    row = lambda **p: {"type": "object", "properties": p, "required": list(p)}
    put("tags-index.schema.json", {"properties": {"tags": {"items": {"$ref": "#/$defs/tag"}}}, "$defs": {"tag": {**row(id={"type": "string"}, slug={"type": "string", "minLength": 1}, name={"type": "string"}, color={"type": ["string", "null"]}, recipe_count={"type": "integer", "minimum": 1}), "additionalProperties": False}}})
    put("release.schema.json", row(catalog_version={"const": "v1"}, latest_manifest=row(sha256={"type": "string", "pattern": "^[a-f0-9]{64}$"})))
    assert build_catalog(docs, str(tmp_path / "a"), schemas=str(folder))["repo_sequence"] == 1
    put("release.schema.json", row(catalog_version={"const": "v2"}))
    with pytest.raises(Exception, match="schema validation failed for release"):
        build_catalog(docs, str(tmp_path / "b"), schemas=str(folder))
    assert not (tmp_path / "b/release.json").exists()
    put("recipe.schema.json", row(servings={"type": "integer", "minimum": 5}))
    with pytest.raises(Exception, match="schema validation failed for document"):
        build_catalog(docs, str(tmp_path / "c"), schemas=str(folder))


def test_state_and_lists(spark, tmp_path):
    state = f"{tmp_path}/state.json"
    assert D.read_state(spark, state).count() == 0
    items = spark.createDataFrame([(i, f"n{i}") for i in "edcba"], "id string, name string")
    seen = []

    def work(some):
        seen.append([r.id for r in some.collect()])
        return some.where("id <> 'b'").select("id", (F.col("id") != "c").alias("written"))

    D.write_state(spark.createDataFrame([("reviewed", "a", 0), ("reviewed", "a", 5), ("written", "a", 0)], "kind string, id string, seq long"), state)
    done = work_through(items, D.read_state(spark, state), work, batch=2)
    D.write_state(done, state)
    saved = json.loads((tmp_path / "state.json").read_text())
    assert seen == [["b", "c"], ["d", "e"]] and saved["reviewed_ids"][0] == "a" and sorted(saved["reviewed_ids"]) == list("abcde") and sorted(saved["written_ids"]) == ["a", "d", "e"]
    (tmp_path / "bad.json").write_text('{"reviewed_ids": 3}')
    with pytest.raises(ValueError, match="invalid state"):
        D.read_state(spark, f"{tmp_path}/bad.json")
    D.write_url_list(spark.createDataFrame([("https://b",), ("https://a",)], "url string"), f"{tmp_path}/u.txt")
    assert (tmp_path / "u.txt").read_text() == "https://a\nhttps://b\n"
    assert {(r.url, r.place.part) for r in I.ordered_union("url", *(spark.createDataFrame(x, "url string, place int") for x in ([("a", 1), ("b", 2)], [("b", 1), ("c", 2)]))).collect()} == {("a", 0), ("b", 0), ("c", 1)}


def test_documents_are_written_and_rewritten(spark, tmp_path):
    docs = spark.createDataFrame([("a.json", "a", "é", 1), ("a.json", "a", "new", 2), ("b.json", "b", None, 1)], "_file string, slug string, name string, revision int")
    D.write_documents(docs, str(tmp_path / "by-id"))
    assert (tmp_path / "by-id/a.json").read_text() == json.dumps({"slug": "a", "name": "new", "revision": 2}, indent=2) + "\n" and len(list((tmp_path / "by-id").iterdir())) == 2
    old = (tmp_path / "by-id/b.json").read_bytes()
    read = spark.read.option("multiLine", True).json(f"{tmp_path}/by-id").withColumn("path", F.col("_metadata.file_path"))
    assert D.rewrite_changed(read.where("slug = 'a'").withColumn("name", F.lit("é")).withColumn("rows_changed", F.lit(1)), "rows_changed") == 1
    assert json.loads((tmp_path / "by-id/a.json").read_text())["name"] == "é" and "\\u00e9" in (tmp_path / "by-id/a.json").read_text() and (tmp_path / "by-id/b.json").read_bytes() == old
    assert {(r.slug, r.name) for r in D.documents_by_slug(read.unionByName(read.withColumn("path", F.lit("z")).withColumn("name", F.lit("last")))).collect()} == {("a", "last"), ("b", "last")}


def test_fetching_and_crawling(spark, tmp_path):
    article = lambda n: f'<article class="category-recipes"><a href="/{n}">x</a></article>'
    pages = {
        "https://x.com/recipes/": f'<main>{article("one")}</main><a class="page-numbers" href="/recipes/page/3/">3</a>', "https://x.com/recipes/page/2/": f'<main>{article("two")}</main>',
        "https://x.com/cover": "image",
    }

    def call(url):
        return pages[url].encode(), "image/webp; q=1"

    start = spark.createDataFrame([("https://x.com/recipes/",)], "url string")
    urls, failed = crawl(start, "x.com", "https://x.com/recipes/", call)
    assert {r.url for r in urls.collect()} == {"https://x.com/one/", "https://x.com/two/"} and [r.url for r in failed.collect()] == ["https://x.com/recipes/page/3/"]
    got, lost = fetch_pages(spark.createDataFrame([("https://x.com/cover",), (None,), ("u",), ("u",)], "url string"), call)
    assert [r.html for r in got.collect()] == ["image"] and ["KeyError" in r.error for r in lost.collect()] == [True]
    images = spark.createDataFrame([("i", "https://x.com/cover"), ("j", "none")], "id string, url string")
    assert {(r.id, r.path) for r in store_images(images, str(tmp_path), call).collect()} == {("i", "i/cover.webp"), ("j", None)} and (tmp_path / "i/cover.webp").read_bytes() == b"image"


def test_arrays_by_position_and_first_in_locale_order(spark):
    rows = spark.createDataFrame([([(3, "c"), None, (1, "a"), (None, "n"), (1, "b")],), ([],), (None,)], "v array<struct<position:int,text:string>>")
    assert [[x and x.text for x in r[0]] if r[0] is not None else None for r in rows.select(I.by_position("v")).collect()] == [["a", "b", "c", None, "n"], [], None]
    names = spark.createDataFrame([(n,) for n in ("b", "É", "a", "Z", "e", "f", "B")], "name string")
    assert [r.name for r in I.first_in_locale_order(names, n=3).collect()] == ["a", "b", "B"]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"slug": "a", "public": True, "tags": [{"slug": "t"}]}, indent=2))
    (tmp_path / "in/b.json").write_text("[broken")
    rows = {r.path.rsplit("/", 1)[1]: r for r in read_documents(spark, str(tmp_path / "in")).collect()}
    assert rows["a.json"].tags[0].slug == "t" and rows["b.json"]._corrupt_record and read_documents(spark, str(tmp_path / "none")).count() == 0
    assert {r.file_sha256 for r in read_hashes(spark, str(tmp_path / "in")).collect()} == {hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "in").iterdir()}
    (tmp_path / "urls.txt").write_text("https://x/a#b\n# note\n\n https://x/c \n")
    assert [r.url for r in read_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["https://x/a", "https://x/c"]
    dump_rows(tmp_path / "o.json", {"h": 1}, "rows", spark.createDataFrame([("é", None)], "a string, b string"))
    want = {"h": 1, "rows": [{"a": "é", "b": None}]}
    assert (tmp_path / "o.json").read_text() == json.dumps(want, indent=2, ensure_ascii=True) + "\n"
    dump_rows(tmp_path / "e.json", {"h": {"x": [1]}}, "rows", spark.createDataFrame([], "a string"))
    assert (tmp_path / "e.json").read_text() == json.dumps({"h": {"x": [1]}, "rows": []}, indent=2) + "\n"


def test_manifest_stream(spark, tmp_path):
    changes = [[(1, "upsert", "a", "h1"), (1, "upsert", "b", "h1")], [(3, "remove", "b", None), (2, "upsert", "b", "h2")], [(2, "upsert", "a", "h2"), (2, "upsert", "b", "late")]]
    for rows in changes:
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        follow(read_changes(spark, str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "check"), parts=8).awaitTermination()
        state = {r.id: (r.sequence, r.digest, r.gone) for r in read_state(spark, str(tmp_path / "state")).collect()}
    # the second batch is about b alone, so the part of a has no version of it
    assert sorted(p.name for p in (tmp_path / "state").glob("part=*/version=*")) == ["version=0", "version=0", "version=1", "version=2", "version=2"]
    assert {r.id: r.sequence for r in read_state(spark, str(tmp_path / "state"), 0).collect()} == {"a": 1, "b": 1}
    assert state == {"a": (2, "h2", False), "b": (3, None, True)}
    empty = spark.createDataFrame([], "id string, sequence long, digest string, gone boolean")
    assert apply_changes(empty, spark.createDataFrame([], CHANGE)).count() == 0
