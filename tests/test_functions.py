import pytest
from pyspark.sql import functions as F

from shelfscan.functions import keys, numbers, text, units
from shelfscan.operators.clean import clean_names, with_brands, with_sizes, with_unit_prices
from shelfscan.operators.match import with_match_keys


def one_column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_price_text(spark):
    cases = {"Rs. 1,250.00": 1250.0, "PKR 999": 999.0, "-5": 5.0, "1,250 - 1,500": 1250.0, "": None, "abc": None, None: None, "rs.75/-": 75.0}
    assert one_column(spark, list(cases), "STRING", text.parse_price) == list(cases.values())


def test_numeric_coercion(spark):
    cases = {"12.5": 12.5, " 7 ": 7.0, "1e3": 1000.0, "12d": None, "x": None, "": None, None: None}
    assert one_column(spark, list(cases), "STRING", text.to_number) == list(cases.values())


def test_clean_text(spark):
    cases = {"Crème  X": "Crème X", "½ kg ™": "1⁄2 kg TM", " a \x1c\t b\n": "a b", None: "", "": ""}
    assert one_column(spark, list(cases), "STRING", text.clean_text) == list(cases.values())


@pytest.mark.parametrize("stepwise", [False, True])
def test_promos_are_removed_inside_words_in_order(spark, stepwise):
    cases = {"SALE Photo": "Po", "Salem tea": "m tea", "sNew!ale": "", "Lımıted x": "x", "Best  Seller a": "a", "plain name": "plain name"}
    if not stepwise:
        assert one_column(spark, list(cases), "STRING", text.clean_name) == list(cases.values())
    else:
        rows = spark.createDataFrame([(n,) for n in cases], "product_name STRING")
        kept = {r["product_name"]: r["product_name_clean"] for r in clean_names(rows).collect()}
        assert kept == {n: c for n, c in cases.items() if len(c) > 2}


def test_brands(spark):
    cases = {
        "Lux Soap": "Lu", "7up 1.5l": "7Up", "peek freans sooper": "Peek Freans", "foo-bar x": "Foo-Bar", "### x": "Unknown",
        "Clearasil": "Clear", "Evaporated milk": "Eva", "o'neil chips": "Oneil", "brand2b x": "Brand2B", "": "Unknown",
    }
    assert one_column(spark, list(cases), "STRING", text.extract_brand) == list(cases.values())


def test_sizes(spark):
    cases = {
        "Tapal Danedar 950g": (950.0, "g"), "Olpers Milk 1.5 Ltr": (1.5, "l"), "Surf Excel 2kg": (2.0, "kg"), "Colgate 150ml": (150.0, "ml"),
        "Lays Classic 40g x12": (40.0, "g"), "950gm": (950.0, "g"), "1/2 kg": (2.0, "kg"), "6 Pack": (6.0, "pack"), "2 rolls": (2.0, "roll"),
        "1 roll": (None, None), "1,5 kg": (5.0, "kg"), ".5kg": (5.0, "kg"), "5 kgs": (None, None), "۵ kg": (5.0, "kg"), None: (None, None),
    }
    got = one_column(spark, list(cases), "STRING", lambda c: F.struct(units.quantity(units.size_text(c)).alias("q"), units.unit(units.size_text(c)).alias("u")))
    assert [tuple(g) for g in got] == list(cases.values())


def test_unit_prices(spark):
    rows = [(950.0, "g", 1200.0), (1.5, "l", 300.0), (6.0, "pack", 90.0), (0.0, "g", 10.0), (5.0, "bag", 10.0), (None, None, 10.0), (2.0, "kg", 7.0), (3.0, "g", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, quantity DOUBLE, unit STRING, price DOUBLE")
    got = [tuple(r) for r in with_unit_prices(df).orderBy("i").select("qty_normalized", "unit_normalized", "price_per_unit").collect()]
    assert got == [
        (950.0, "g", 1263.16), (1500.0, "ml", 200.0), (6.0, "pcs", 15.0), (0.0, "g", None), (5.0, "bag", None), (None, None, None), (2000.0, "g", 3.5), (None, None, None),
    ]


def test_match_keys(spark):
    names = ["Tapal Danedar Tea 950g", "Surf Excel Powder 2kg", "Crème brulee mix", "Brand1 red new widget large economy 5kg", "ab", "x 10000000 g oil"]
    df = spark.createDataFrame([(n,) for n in names], "product_name STRING").withColumn("product_name_clean", text.clean_text(F.col("product_name")))
    rows = with_match_keys(with_sizes(with_brands(df))).withColumn("short_key", keys.short_key(F.col("name_key")))
    got = {r["product_name"]: (r["match_key"], r["name_key"], r["short_key"]) for r in rows.collect()}
    assert got["Tapal Danedar Tea 950g"] == ("tapal_danedar_tea_950_g", "tapal_danedar_tea", None)
    assert got["Surf Excel Powder 2kg"] == ("surfexcel_surf_excel_powder_2_kg", "surfexcel_surf_excel_powder", None)
    assert got["Crème brulee mix"][1] == "creme_cre_me_brulee_mix"
    assert got["Crème brulee mix"][2] == "creme_cre_me_brulee"
    assert got["Brand1 red new widget large economy 5kg"] == ("brand1_red_widget_large_5_kg", "brand1_red_widget_large", None)
    assert got["ab"] == (None, None, None)
    assert got["x 10000000 g oil"][0] == "x_oil_10000000_g"


def test_size_token_never_prints_an_exponent(spark):
    cases = {1e7: "10000000_g", 12345678.5: "12345678.5_g", 0.0005: "0.0005_g", 1.5: "1.5_g", 950.0: "950_g", 0.0: "0_g", 100.0: "100_g", None: None}
    assert one_column(spark, list(cases), "DOUBLE", lambda c: keys.size_token(c, F.lit("g"))) == list(cases.values())


def test_catalogue_key(spark):
    df = spark.createDataFrame([("Tapal  Tea!", 950.0, "g"), ("Tea", None, None), ("", None, None)], "n STRING, q DOUBLE, u STRING")
    got = [r[0] for r in df.select(keys.catalogue_key(F.col("n"), F.col("q"), F.col("u"))).collect()]
    assert got == ["tapal_tea__950.0_g", "tea", "unknown"]


def test_categories_links_and_verdicts(spark):
    df = spark.createDataFrame([("Salt", "", "x"), ("odd", "fresh milk", "choc"), ("", "", "Rice oil"), (None, None, None)], "t STRING, g STRING, n STRING")
    got = [r[0] for r in df.select(text.classify_category(F.col("t"), F.col("g"), F.col("n"))).collect()]
    assert got == ["staples", "dairy", "staples", "general"]
    urls = ["https://m.example/dry-fruit/x", "", None]
    assert one_column(spark, urls, "STRING", lambda c: text.category_from_url(c, "https://m.example/")) == ["Dry Fruit", "General", "General"]
    assert one_column(spark, ["a/b/hair-care"], "STRING", lambda c: text.category_from_url(c, last=True)) == ["Hair Care"]
    links = ["//x/y", "/p", "https://z", ""]
    assert one_column(spark, links, "STRING", lambda c: text.absolute_url(c, "https://b")) == ["https://x/y", "https://b/p", "https://z", ""]
    assert one_column(spark, [0.2, -0.2, 0.05, None], "DOUBLE", numbers.correlation_verdict) == ["positive", "negative", "none", None]
    assert one_column(spark, [4.9, 5.0, 20.0], "DOUBLE", numbers.missing_status) == ["OK", "WARNING", "BAD"]
    assert one_column(spark, [0.125, -0.125, None], "DOUBLE", lambda c: numbers.round_half_up(c, 2)) == [0.13, -0.13, None]


def test_sizes_are_found_in_one_way_only(spark):
    """Long numbers: a pattern that gives digits back tries every way to split them, and does not end in time."""
    import time

    digits = "1" * 3000
    names = ["1.2.3kg", "1.23.4 kg tea", "12 kgs 5.kg", "tea 5\u00a0 ml", "5 .g", "7..5g", "3 g_ 4 l", f"{digits} tea {digits} 2 l"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    start = time.monotonic()
    rows = df.select(units.size_text(F.col("n")), keys.product_words(F.col("n"))).collect()
    assert time.monotonic() - start < 20
    assert [tuple(r) for r in rows[:7]] == [
        ("2.3kg", ""), ("23.4 kg", "tea"), ("5.kg", "12_kgs"), ("5\u00a0 ml", "tea"), ("", ""), ("5g", ""), ("4 l", ""),
    ]
    assert rows[7][0] == "2 l" and rows[7][1] == f"{digits}_tea_{digits}"


def test_the_first_word_keeps_ascii_letters_digits_and_dashes(spark):
    names = ["Z-9 tea", "\u00c9cole's tea", "a_b c", "\u0663x y", "!! b", " \u00a0Al-Fatah x"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    found = [r[0] for r in df.select(text.extract_brand(F.col("n"))).collect()]
    assert found == ["Z-9", "Coles", "Ab", "X", "Unknown", "Al-Fatah"]
