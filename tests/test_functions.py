import uuid

from pyspark.sql import functions as F
from stockpot.functions import classify as C
from stockpot.functions import text as X
from stockpot.functions.ids import entity_id
from stockpot.functions.words import NAMESPACES


def test_uuid5_equals_the_standard_one(values):
    keys = ["salt", "", "naïve glaze", "a" * 500, None]
    want = [None if k is None else str(uuid.uuid5(uuid.UUID(NAMESPACES["ingredient"]), k)) for k in keys]
    assert values(lambda v: entity_id("ingredient", F.col(v)), *keys) == want


def test_cleaning_differs_by_purpose(values):
    texts = ["  • a  b ▢", None, "", "x\n\ty", "a &amp; b"]
    assert values(lambda v: X.clean_page(F.col(v)), *texts) == ["a b", "", "", "x y", "a &amp; b"]
    assert values(lambda v: X.clean_build(F.col(v)), *texts) == ["a b", "", "", "x y", "a & b"]
    assert values(lambda v: X.clean_repair(F.col(v)), *texts) == ["• a b ▢", "", "", "x y", "a &amp; b"]


def test_names_and_slugs(values):
    assert values(lambda v: X.normalize_name(F.col(v)), "Pork (Belly), 1/2-inch!", "-/ x /-", None) == ["pork 1/2-inch", "x", ""]
    assert values(lambda v: X.slugify(F.col(v)), "Crème  Brûlée!", "--", None) == ["cr-me-br-l-e", "", ""]
    assert values(lambda v: X.title_case(F.col(v)), "a-b c_d", "EASY-Recipes éT", "") == ["A-B C_D", "Easy-Recipes Ét", ""]
    assert values(lambda v: X.title_of_slug(F.col(v)), "abc-2nd-x") == ["Abc 2Nd X"]


def test_singular_keeps_known_artefacts(values):
    assert values(lambda v: X.singularize(F.col(v)), "cookies", "cheeses", "almonds", "mangoes", "leaves", "eggs", "glass", "bus", "") == ["cooky", "chees", "almonds", "mango", "leaf", "egg", "glass", "bus", ""]


def test_core_name(values):
    got = values(lambda v: X.core_name(F.col(v)), "scallions", "A bunch of green onions", "a can of tuna", "whole large tilapia", "eggs", "", None)
    assert got == ["scallion", "green onion", "canned tuna", "tilapia", "egg", "", ""]


def test_durations(values):
    assert values(lambda v: C.iso_duration_minutes(F.col(v)), "PT1H30M", "PT45S", "P1DT2H30M", "P", None, "x") == [90, 1, 150, 0, None, None]
    rows = values(lambda v: C.labelled_minutes(F.col(v)), "cook time: 1 hour 30 minutes", "Prep Time 5 mins cook: 7 minutes, cooking 9 minutes", "total time 3 hours", None)
    assert [tuple(r) for r in rows] == [(None, 60, None), (5, 9, None), (None, None, None), (None, None, None)]


def test_plural_quantities(values):
    assert values(lambda v: C.is_plural(F.col(v)), "one", "1/2", "1 1/2", "2 to 3", None, "1/0", "a") == [False, False, True, True, False, False, False]


def test_units_and_preparations(spark):
    rows = spark.createDataFrame([("3", "garlic, minced"), ("2", "bay leaf"), ("1", "water spinach"), (None, "garlic")], "q string, n string")
    got = rows.select(C.inferred_unit(F.col("q"), F.col("n"), F.col("n")), C.inferred_preparation(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("cloves", "minced"), ("pieces", None), ("piece", None), (None, None)]


def test_difficulty(spark):
    rows = spark.createDataFrame([(5, 5, 10, None), (6, 0, 0, 0), (5, 0, 75, 0), (14, 0, 0, 0)], "s int, p int, c int, r int")
    assert [r[0] for r in rows.select(C.infer_difficulty(*map(F.col, "spcr"))).collect()] == ["easy", "medium", "hard", "expert"]


def test_recipe_types(spark):
    rows = spark.createDataFrame([(["Pancake", "x"],), (["inside"],), (["Dinner"],), (["Dinner party"],), ([],)], "v array<string>")
    assert [r[0] for r in rows.select(C.infer_recipe_type(F.col("v"))).collect()] == ["dessert", "side", "main", None, None]


def test_total_minutes_and_times(spark):
    rows = spark.createDataFrame([(None, None, None), (10, 20, 5), (0, 0, None)], "a int, b int, c int")
    assert [r[0] for r in rows.select(C.total_minutes(*map(F.col, "abc"))).collect()] == [None, 35, None]
    one = spark.range(1).select(C.utc_text(F.lit(0)).alias("a"), C.iso_to_seconds(F.lit("2024-01-02T03:04:05Z")).alias("b"), C.iso_to_seconds(F.lit("x")).alias("c")).first()
    assert tuple(one) == ("1970-01-01T00:00:00Z", 1704164645, None)


def test_image_extension(spark):
    rows = spark.createDataFrame([("https://x/a/b.PNG?q=1", None), ("https://x/a", "image/webp; x"), ("https://x/", None), (None, None)], "u string, t string")
    assert [r[0] for r in rows.select(C.image_extension(F.col("u"), F.col("t"))).collect()] == [".png", ".webp", ".jpg", ".jpg"]


def test_iso_dates(values):
    import datetime

    texts = ["2024-01-02T03:04:05Z", "20240102", "2024-01-02", "2024", "2024-1-2", "20240102T030405", "2024-01-02 03:04", "2024-01-02T03", "2024-01-02T03:04:05.678+05:30", "2024-13-01", "2024-01-02T03:04:05-0230", "x", "", "2024-01-02T", "2024-01-02x03:04:05,5"]

    def want(text):
        try:
            at = datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return int((at if at.tzinfo else at.replace(tzinfo=datetime.UTC)).timestamp())

    assert values(lambda v: C.iso_to_seconds(F.col(v)), *texts, None) == [*map(want, texts), None]


def test_times_dates_and_places(spark):
    rows = spark.createDataFrame([(None, 5, 3, 0), (9, 5, 3, None), (None, None, 3, 1704164645), (None, None, None, 1)], "t int, c int, p int, s long")
    assert [tuple(r) for r in rows.select(C.shown_minutes(*map(F.col, "tcp")), C.display_date(F.col("s"))).collect()] == [(5, "1/1/1970"), (9, "Unknown"), (3, "1/2/2024"), (0, "1/1/1970")]
    one = spark.range(1).select(X.manifest_path_of_sequence(F.lit(12)), X.asset_url("https://x/r/", "main", F.lit("/a/b.png"))).first()
    assert tuple(one) == ("manifests/0000000012.json", "https://x/r/raw/main/a/b.png")
