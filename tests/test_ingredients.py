import pytest
from pyspark.sql import functions as F
from stockpot.operators.ingredients import canonicalize_lines, normalize_lines, split_text
from stockpot.plans.catalog import canonical_ingredients, canonical_lines, review_queue

LINES = [
    ("egg", None, None), ("eggs (beaten)", None, None), ("pig kidney (cleaned)", None, None), ("whole large tilapia (cleaned (scales and gut removed))", None, None),
    ("A bunch of green onions (cut in 3 inch length)", None, None), ("a can of tuna", None, None), ("Water for boiling egg", None, None), ("A double boiler", None, None),
    ("salt and ground black pepper", None, None), ("apple cider or apple juice", None, None), ("bread", "1", "slice"), ("salt", "to taste", "piece"),
    (">> Sauce:", None, None), ("2 1/2 cups sugar, sifted", None, None), ("salt &amp; pepper (optional)", None, None), ("", None, None), (None, None, None),
]


@pytest.fixture(scope="module")
def canonical(spark):
    rows = [(i, "x", n, n, q, u, None) for i, (n, q, u) in enumerate(LINES)]
    lines = spark.createDataFrame(rows, "i int, ingredient_id string, name string, normalized_name string, quantity string, unit string, preparation string")
    return {r.i: r for r in canonicalize_lines(normalize_lines(lines)).collect()}


def test_kept_names_and_preparations(canonical):
    kept = {i: [(k.name, k.preparation) for k in r.kept] for i, r in canonical.items()}
    assert kept[0] == [("egg", None)] and kept[1] == [("egg", "beaten")]
    assert canonical[0].kept[0].ingredient_id == canonical[1].kept[0].ingredient_id
    assert kept[2] == [("pig kidney", "cleaned")]
    assert kept[3][0][0] == "tilapia" and kept[4][0][0] == "green onion" and kept[5] == [("canned tuna", None)]
    assert kept[8] == [("salt", None), ("ground black pepper", None)]
    assert kept[13] == [("sugar", "sifted")]
    for i in (6, 7, 9, 12, 15, 16):
        assert kept[i] == []


def test_review(canonical):
    way = {i: r.review and (r.review.resolution, list(r.review.issue_types)) for i, r in canonical.items()}
    assert way[6] == way[7] == ("excluded", ["excluded_non_ingredient"])
    assert way[8] == ("split", ["compound_split"]) and way[9] == ("review", ["ambiguous_connector"])
    assert way[14] == ("canonicalized", ["optional"]) and way[12] is None and way[0] is None
    assert canonical[8].review.replacements == ["salt", "ground black pepper"]


def test_unknown_units_leak_into_names(canonical):
    assert (canonical[10].name, canonical[10].quantity, canonical[10].unit) == ("slice bread", "1", "slice")
    assert (canonical[11].name, canonical[11].quantity, canonical[11].unit) == ("taste piece salt", "to", "piece")


def test_split_text_of_pages(spark):
    texts = spark.createDataFrame([("1 1/2 cups flour, sifted",), ("2 packs noodles",), ("½ tsp. of salt - fine",), ("",), (None,)], "t string")
    rows = [(r.quantity, r.unit, r.name, r.preparation) for r in split_text(texts, "t", page=True).collect()]
    assert rows == [("1 1/2", "cups", "flour", "sifted"), ("2", None, "packs noodles", None), ("1/2", "tsp", "salt", "fine"), (None, None, "", None), (None, None, "", None)]


def test_documents_renumber_what_is_kept(spark):
    kind = "rec_no long, slug string, name string, ingredients array<struct<ingredient_id:string,name:string,normalized_name:string,quantity:string,unit:string,preparation:string,position:int>>"
    item = lambda n, p: ("x", n, n, None, None, None, p)
    docs = spark.createDataFrame([(1, "s", "S", [item(">> A:", 1), item("salt and pepper", 2), None, item("gin or sherry", 3), item("egg", 4)]), (2, "t", "T", None)], kind)
    lines = canonical_lines(docs, "rec_no")
    kept = [(r.document, r.position, r.name) for r in canonical_ingredients(lines).orderBy("document", "position").collect()]
    assert kept == [(1, 1, "salt"), (1, 2, "pepper"), (1, 3, "egg")]
    assert {(r.position, r.resolution) for r in review_queue(lines).collect()} == {(2, "split"), (3, "review")}


def test_texts_of_any_length_keep_their_end(spark):
    texts = ["2 cups of " + "w " * 10_050 + "end", "w " * 10_050 + "end", "2 cups", "2", ""]
    got = {r.i: (r.quantity, r.unit, r.name) for r in split_text(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t").collect()}
    words = "w " * 10_050 + "end"
    assert got[0] == ("2", "cups", words) and got[1] == (None, None, words)
    assert got[2][:2] == ("2", "cups") and got[3][:2] == ("2", None) and got[4] == (None, None, "")


def test_brackets_and_notes_of_any_number(values):
    from stockpot.operators.ingredients import bracket_parts, without_notes, without_outer_brackets

    deep = "a " + "(b " * 12 + "c" + ")" * 12
    got = values(lambda v: bracket_parts(F.col(v)), deep, "x (y) (z (w)) (", "((", "", None)
    assert (got[0].base, len(got[0].parts), got[0].parts[0], got[0].parts[-1]) == ("a", 12, "b c", "b")
    assert [(g.base, list(g.parts)) for g in got[1:]] == [("x (", ["y", "w", "z"]), ("((", []), ("", []), ("", [])]
    assert values(lambda v: without_outer_brackets(F.col(v)), "(" * 20 + "a" + ")" * 20, "(a) (b)", "((a) (b))", "(a", "()", "( (a) )", "(", "") == ["a", "(a) (b)", "(a) (b)", "(a", "", "a", "(", ""]
    notes = values(lambda v: without_notes(F.col(v)), "salt (see note 1) (see notes 2) (See Note 3)4", "salt (x (see note 1) y)", "salt 5", "a (see (see note) note) 3", "oil 7 (see note 1)")
    assert notes == ["salt", "salt y)", "salt 5", "a note)", "oil"]
