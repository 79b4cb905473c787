import datetime
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from stockpot.operators.nested import common_rows, flatten_columns, flatten_document, flatten_json, state, variant_tables
from stockpot.operators.packed import explode_packed, joined_names, split_packed
from stockpot.operators.quantities import NUMBERED, calibrate, convert_quantities, parse_line, statements
from pyspark.sql import functions as F

FACTORS = [("g", "g", 1.0), ("kg", "g", 1000.0), ("oz", "g", 28.4), ("ml", "ml", 1.0), ("tsp", "ml", 5.0), ("tbsp", "ml", 15.0), ("cup", "ml", 240.0), ("l", "ml", 1000.0)]
LINE = "line_id long, quantity string, unit string, name string, preparation string, unit_of string"


def _amounts(spark, rows, extra=None):
    lines = spark.createDataFrame([(i, *r, None, "clash") for i, r in enumerate(rows)], LINE)
    factors = spark.createDataFrame(FACTORS, "unit string, base_unit string, factor double")
    return {r.line_id: (r.base_unit, r.low_milli, r.high_milli) for r in convert_quantities(lines, factors).collect()}


def test_amounts_in_all_places(spark):
    rows = [
        ("1 1/2", "cups", "water"), ("1-1/2", "T", "salt"), ("1", "t", "salt"), ("0,25", "kg", "pear"), ("⅛ to 1/4", "tsp", "salt"), ("75 - 80", "grms", "nutmeg"),
        ("2", "14-oz Can", "beans"), ("2", "box (200 ml)", "beans"), ("4", "can", "nata (400 ml)"), (None, None, "3 (8-oz) sachet corn"), (None, None, "palm hearts, 2 packs of 8-oz each"),
        ("3", "cup", "oil (720 ml)"), (None, "1/4 tsps", "oats"), ("4 ozs", "", "nuts"), (None, None, "sauce: 1 kg."), ("two", "cups", "rice"), ("5", "pieces", "egg"), ("to taste", None, "salt"),
        (None, "pinch", "salt"), (None, None, "2% milk"), (None, None, None), ("", "", ""), ("1/0", "cup", "x"), (None, None, "200 gram salsify " + "x" * 20000),
    ]
    got = _amounts(spark, rows)
    got_a = _amounts(spark, [("a", "cup", "oil"), ("An", "cup", None), (None, None, "a cup of oil"), (None, "a cup", None)])
    assert got_a == dict.fromkeys(range(4), ("ml", 240000, 240000))
    want = {
        0: ("ml", 360000, 360000), 1: ("ml", 22500, 22500), 2: ("ml", 5000, 5000), 3: ("g", 250000, 250000), 4: ("ml", 625, 1250), 5: ("g", 75000, 80000),
        6: ("g", 795200, 795200), 7: ("ml", 400000, 400000), 8: ("ml", 1600000, 1600000), 9: ("g", 681600, 681600), 10: ("g", 454400, 454400),
        11: ("ml", 720000, 720000), 12: ("ml", 1250, 1250), 13: ("g", 113600, 113600), 14: ("g", 1000000, 1000000), 15: ("ml", 480000, 480000), 23: ("g", 200000, 200000),
    }
    assert got == want


def test_pairs_tell_the_scale_of_an_unlisted_spelling(spark):
    rows = [(str(n), "gobletful", f"oil ({240 * n} ml)") for n in range(1, 8)] + [("2", "gobletful", "oil")]
    got = _amounts(spark, rows)
    assert got[0] == ("ml", 240000, 240000)


def test_learned_spellings_are_read_in_texts(spark):
    rows = [(str(n), "gobletful", f"oil ({240 * n} ml)") for n in range(1, 8)] + [(None, None, "2 gobletful oil"), (None, None, "3 thimbles oil"), ("two", "gobletfuls", "oil"), ("2", "Gobletful.", "oil")]
    got = _amounts(spark, rows)
    assert got[7] == got[10] == ("ml", 480000, 480000) and 8 not in got and 9 not in got


def _scales(spark, rows, **how):
    lines = spark.createDataFrame([(i, *r, None, "x") for i, r in enumerate(rows)], LINE)
    factors = spark.createDataFrame(FACTORS, "unit string, base_unit string, factor double")
    return {r.spelling: (r.base_unit, r.factor, r.steps, r.pairs) for r in calibrate(statements(lines), factors, **how).collect()}


def test_links_with_an_offset_lead_nowhere(spark):
    warm = [(str(n), "warmth", f"oil ({32 + 1.8 * n:g} ml)") for n in range(2, 60)]
    even = [(str(n), "beaker", f"oil ({30 * n} ml)") for n in range(1, 60)]
    got = _scales(spark, [*warm, *even, ("1", "Cups", "x")])
    # no known conversion has 30 ml, so beaker is no unit here
    assert "warmth" not in got and "beaker" not in got and got["cups"] == ("ml", 240.0, 1, 0)


def test_scales_reach_through_any_number_of_links(spark):
    chain = [(str(n), f"unit{'abcdefg'[k]}", f"oil ({n} unit{'abcdefg'[k - 1]})" if k else f"oil ({5 * n} ml)") for k in range(7) for n in range(1, 5)]
    lines = spark.createDataFrame([(i, None, 0, float(q), float(q), u, None, None, None) for i, (q, u, _) in enumerate(chain)], "line_id long, at timestamp, turn int, lo double, hi double, spelling string, lo2 double, hi2 double, spelling2 string")
    second = spark.createDataFrame([(i, float(n[5:-1].split()[0]), n[5:-1].split()[1]) for i, (_, _, n) in enumerate(chain)], "line_id long, lo2 double, spelling2 string")
    stated = lines.select("line_id", "at", "turn", "lo", "hi", "spelling").join(second, "line_id").select("line_id", "at", "turn", "lo", "hi", "spelling", "lo2", F.col("lo2").alias("hi2"), "spelling2")
    factors = spark.createDataFrame(FACTORS, "unit string, base_unit string, factor double")
    got = {r.spelling: (r.factor, r.steps) for r in calibrate(stated, factors).collect()}
    assert got == {"ml": (1.0, 0)} | {f"unit{c}": (5.0, k + 1) for k, c in enumerate("abcdefg")}


def test_the_last_delivery_of_a_line_counts(spark):
    at = [datetime.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [(1, "1", "cup", "x", None, at[0]), (1, "2", "cup", "x", None, at[1]), (2, "1", "cup", "x", None, at[2]), (2, "9", "cup", "x", None, None), (3, "1", "cup", "x", None, at[0]), (3, "some", None, "x", None, at[1])]
    lines = spark.createDataFrame(rows, "line_id long, quantity string, unit string, name string, preparation string, loaded_at timestamp")
    factors = spark.createDataFrame(FACTORS, "unit string, base_unit string, factor double")
    assert {r.line_id: r.low_milli for r in convert_quantities(lines, factors).collect()} == {1: 480000, 2: 240000}


_PIECES = ["a", "an", "one", "Half", "quarter", "١", "½", "２", "cup", "cups", "kg", "ſix", "SIX", "to", "-", "and", " ", "\u00a0", "\t", "salt", "é", "x", "(", ")", "/", "3", "0.5", "_", "stone", "ten"]


def test_no_text_that_the_parser_reads_is_left_in_the_scan(spark):
    import random

    draw = random.Random(7)
    texts = ["".join(draw.choice(_PIECES) + draw.choice(["", " "]) for _ in range(draw.randint(1, 6))) for _ in range(6000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    passed = {r.i for r in rows.where(F.col("t").rlike(NUMBERED)).collect()}
    lost = [t for i, t in enumerate(texts) if i not in passed and (parse_line(t, "cup", None) and not parse_line("", "cup", None) or parse_line(None, None, t) or parse_line(None, t, None))]
    assert not lost and len(passed) > 1000


def test_amounts_in_preparation(spark):
    typed = ["250 grams, softened", "2 pounds", "8 ounces", "1 pound", "8 fl oz", "2 tablespoons", "1 litre", "half a cup", "two cups, chopped", "cut in 2 cm cubes", "in half", "a pinch", None]
    lines = spark.createDataFrame([(i, None, None, "salt", p) for i, p in enumerate(typed)], "line_id long, quantity string, unit string, name string, preparation string")
    factors = spark.createDataFrame([*FACTORS, ("lb", "g", 454.0), ("fl oz", "ml", 30.0)], "unit string, base_unit string, factor double")
    got = {r.line_id: (r.base_unit, r.low_milli) for r in convert_quantities(lines, factors).collect()}
    assert got == {0: ("g", 250000), 1: ("g", 908000), 2: ("g", 227200), 3: ("g", 454000), 4: ("ml", 240000), 5: ("ml", 30000), 6: ("ml", 1000000), 7: ("ml", 120000), 8: ("ml", 480000)}


def test_no_lines(spark):
    lines = spark.createDataFrame([], LINE)
    assert convert_quantities(lines, spark.createDataFrame(FACTORS, "unit string, base_unit string, factor double")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30), st.text(max_size=30), st.text(max_size=60))
def test_any_line_can_be_read(quantity, unit, name):
    assert len(parse_line(quantity, unit, name)) <= 2


NAMES = ["bread-and-butter pickle", "half and half", "50/50 flour blend", "macaroni and cheese mix"]


def _split(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(split_packed(F.col("t"), NAMES)).collect()]


def test_split_packed(spark):
    cases = {
        "a, b and c": ["a", "b", "c"], "a,b, and c": ["a", "b", "c"], "a / b|c • d + e & f": ["a", "b", "c", "d", "e", "f"], "a\nb\tc": ["a", "b", "c"], "a, , b,": ["a", "b"],
        'x; "half grated / half whole"': ["x", "half grated / half whole"], '"trimmed to 3"" lengths", b': ['trimmed to 3" lengths', "b"], "'soy sauce';y": ["soy sauce", "y"],
        "cut (a, b) and c": ["cut (a, b)", "c"], "cut 1/2 inch, 1,5 cm": ["cut 1/2 inch", "1,5 cm"], "Macaroni And Cheese Mix and 50/50 flour blend": ["Macaroni And Cheese Mix", "50/50 flour blend"],
        "x": ["x"], "": [], "brandy": ["brandy"], "cook's salt, b": ["cook's salt", "b"], "a (b (c, d), e), f": ["a (b (c, d), e)", "f"], "sand and": ["sand and"],
        "one and a half cups salt, egg": ["one and a half cups salt", "egg"], "Mix macaróni  and cheese; x": ["Mix macaróni  and cheese", "x"], "macaroni and cheese mixes": ["macaroni and cheese mixes"],
    }
    assert _split(spark, *cases) == list(cases.values())


def test_split_within_brackets_of_any_depth(spark):
    deep = "a (x, b (c, (d / (e and f, (g (h, i)))))), j"
    cases = {
        deep: ["a (x, b (c, (d / (e and f, (g (h, i))))))", "j"], "a [b, [c, [d, e]], f], g": ["a [b, [c, [d, e]], f]", "g"], "a {b {c, d}, e}; f": ["a {b {c, d}, e}", "f"],
        "a (b (c (d (e, f": ["a (b (c (d (e", "f"], "a (b, c) (d, e) (f, g) (h, i), j": ["a (b, c) (d, e) (f, g) (h, i)", "j"], "a) b, (c": ["a) b", "(c"], "(" * 12 + "a, b" + ")" * 12 + " and c": ["(" * 12 + "a, b" + ")" * 12, "c"],
    }
    assert _split(spark, *cases) == list(cases.values())


def test_split_of_very_long_texts(spark):
    long = "a" * 300_000
    cases = {f"({long}, b), c": [f"({long}, b)", "c"], f'"{long}, b", c': [f"{long}, b", "c"], f"{long} and b": [long, "b"], f"{long} x and b": [f"{long} x", "b"], "(x, y) " * 5_000 + ", z": [("(x, y) " * 5_000).strip(), "z"]}
    assert _split(spark, *cases) == list(cases.values())


def test_split_keeps_mistyped_names_and_odd_characters(spark):
    cases = {
        "macroni and cheese mox": ["macroni and cheese mox"], "  hslf and haf": ["hslf and haf"], "salt, hslf  and haf and egg": ["salt", "hslf  and haf", "egg"], "rice and cheese": ["rice", "cheese"], "half and egg": ["half", "egg"],
        "bread and butter pickle, x": ["bread and butter pickle", "x"], "bread and butter": ["bread", "butter"], "a\ufdd0b, \ufdd3c\ufdd1, \"d, \ufdd0\"": ["a\ufdd0b", "\ufdd3c\ufdd1", "d, \ufdd0"], "a\ue000, b": ["a\ue000", "b"],
    }
    assert _split(spark, *cases) == list(cases.values())
    other = spark.createDataFrame([("sal y agua e hielo",), ("соль и вода",)], "t string").select(split_packed(F.col("t"), [], ("y", "e", "и")))
    assert [r[0] for r in other.collect()] == [["sal", "agua", "hielo"], ["соль", "вода"]]


def test_the_last_delivery_of_a_packed_field_counts(spark):
    rows = [(1, "a, b", 1), (1, "c, d, e", 2), (2, "a, b", 1), (2, "a", 2), (3, "a, b", None), (3, "x; y", 1), (4, "a, b", 1), (4, None, 2)]
    lines = spark.createDataFrame(rows, "line_id long, name string, at int")
    assert {(r.line_id, r.item) for r in explode_packed(lines, ["line_id"], ["name"], [], "at").collect()} == {(1, "c"), (1, "d"), (1, "e"), (3, "x"), (3, "y")}


def test_packed_fields(spark):
    now = datetime.datetime(2024, 1, 1)
    rows = [(1, "a, b", None, now), (1, "a, b", None, now), (2, None, "x;y", now), (3, "solo", "solo", now), (4, "palm hearts, 2 packs of 8-oz each", None, now), (5, None, None, now), (6, ",".join("v%d" % i for i in range(3000)), "", now)]
    lines = spark.createDataFrame(rows, "line_id long, name string, preparation string, item timestamp")
    index = spark.createDataFrame([("Half and Half",), ("salt",), (None,)], "name string")
    assert joined_names(index) == ["half and half"]
    got = {(r.line_id, r.field_name, r.item_no, r.item) for r in explode_packed(lines, ["line_id"], ["name", "preparation"], joined_names(index)).collect()}
    assert {g for g in got if g[0] < 6} == {(1, "name", 1, "a"), (1, "name", 2, "b"), (2, "preparation", 1, "x"), (2, "preparation", 2, "y")}
    assert len([g for g in got if g[0] == 6]) == 3000
    assert explode_packed(lines.limit(0), ["line_id"], ["name"], []).count() == 0


def _rows(document):
    return [(k, s, n, f.get("name") or f.get("text")) for k, s, n, _, _, _, _, f, _ in flatten_document(document)]


def test_shapes_of_nested_documents():
    item = lambda n: {"name": n, "position": 1}
    document = {
        "ingredients": [item("a"), None, "", {"section": "S", "ingredients": [item("b"), None]}, {"section": None, "items": ["c"]}, "d"],
        "instructions": {"2": {"text": "y"}, "1": {"text": "x"}, "10": {"text": "z"}},
        "taxonomy": {"categories": {"id": "1", "slug": "s", "name": "N"}, "tags": json.dumps([{"slug": "t", "name": "T"}])},
    }
    want = [
        ("ingredient", 0, 1, "a"), ("ingredient", 1, 2, "b"), ("ingredient", 2, 3, "c"), ("ingredient", 0, 4, "d"),
        ("instruction", 0, 1, "x"), ("instruction", 0, 2, "y"), ("instruction", 0, 3, "z"), ("category", 0, 1, "N"), ("tag", 0, 1, "T"),
    ]
    assert _rows(document) == want == _rows({"recipe": document, "changes_summary": []})
    assert _rows([1]) == _rows(None) == _rows({"tags": None, "ingredients": []}) == []
    assert state({"section": "x", "steps": []}) == "section" and state({"1": 1}) == "numbered<scalar>" and state("[1]").startswith("json:list")


def test_nested_tables(spark):
    deep = lambda n: '{"tags": ' + "[" * n + '"x"' + "]" * n + "}"
    bodies = [
        (1, json.dumps({"tags": ["a", {"slug": "b", "name": "B", "color": None, "weight": [1]}]})), (2, '{"tags": ["a"'), (3, None), (4, ""), (5, "[]"), (6, json.dumps({"tags": "solo"})), (7, json.dumps({"tags": {"²": "q"}})),
        (8, deep(5_000)), (9, deep(100_000)), (10, json.dumps({"ingredients": [{"name": 5, "position": "7"}, {"pos": 2, "position": 3}, {"position": "x"}, 4, True]})), (11, json.dumps({"tags": {"١": "z", "2": "y"}})),
    ]
    rows = flatten_json(spark.createDataFrame(bodies, "rec_no long, body string"))
    tables = variant_tables(rows)
    assert {(r.rec_no, r.child_no, r.text) for r in tables["tag_text"].collect()} == {(1, 1, "a"), (6, 1, "solo"), (8, 1, "x"), (11, 1, "z"), (11, 2, "y")}
    tags = {r.rec_no: r for r in tables["tag_object"].collect()}
    assert (tags[1].slug, tags[1].color, tags[1].extra, tags[1].shape) == ("b", None, {"weight": "[1]"}, "object{color,name,slug,weight}") and tags[7].extra == {"²": '"q"'}
    ingredients = {r.child_no: r for r in tables["ingredient_object"].collect()}
    assert (ingredients[1].name, ingredients[1].position) == ("5", 7) and ingredients[2].position == 2 and ingredients[2].extra == {"position": "3"} and ingredients[3].extra == {"position": '"x"'}
    assert {(r.child_no, r.text, r.shape) for r in tables["ingredient_text"].collect()} == {(4, "4", "scalar"), (5, "true", "scalar")}
    assert common_rows(tables).count() == rows.count() == 12
    assert common_rows(variant_tables(rows.limit(0))).count() == 0


def test_nested_columns(spark):
    kind = "rec_no long, ingredients array<struct<name:string,pos:int,heat:int>>, instructions array<struct<text:string>>, categories array<struct<name:string>>, tags array<struct<name:string>>, child_no int"
    docs = spark.createDataFrame([(1, [("a", 3, 1), None, ("b", None, None)], None, [], [("t",)], 7), (2, None, None, None, None, 7)], kind)
    rows = flatten_columns(docs)
    assert {(r.rec_no, r.child_kind, r.child_no, r.name, r.position) for r in rows.collect()} == {(1, "ingredient", 1, "a", 3), (1, "ingredient", 2, "b", None), (1, "tag", 1, "t", None)}
    assert [r.extra for r in variant_tables(rows)["ingredient_object"].orderBy("child_no").collect()] == [{"heat": "1"}, {"heat": None}]
