"""Column standardisers on literal rows: nulls, blanks, overflow, unknown regions."""

import pytest

from masterloom.functions import (
    code_field,
    concat_phone_parts,
    fill_blank,
    full_address,
    hhmm_time,
    initial_flag,
    last_digits,
    property_code,
    reference_fallback,
    standardize_property_codes,
    strip_special,
)
from masterloom.operators import normalize_phones


def column(spark, values, expression, schema="v string"):
    """The expression's value for each input row, in order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_code_field(spark):
    assert column(spark, [" 7 ", "", "  ", None], code_field("v", "SF")) == ["SF7", None, None, None]
    assert column(spark, ["7"], code_field("v", "SF", "-")) == ["SF-7"]


def test_code_field_twice_is_the_same(spark):
    df = spark.createDataFrame([("7",)], "id string").withColumn("Code", code_field("id", "SF"))
    assert df.withColumn("Code", code_field("id", "SF")).first()["Code"] == "SF7"


def test_reference_fallback(spark):
    values = [(" A ", "b"), ("  ", "b"), (None, " b "), (None, None)]
    expression = reference_fallback("v", "w")
    assert column(spark, values, expression, "v string, w string") == ["A", "b", " b ", None]


def test_full_address(spark):
    values = [(" a ", None, "c"), ("", " ", None), ("x", "y", "z")]
    expression = full_address(["v", "w", "x"])
    assert column(spark, values, expression, "v string, w string, x string") == ["a, c", "", "x, y, z"]


def test_hhmm_time(spark):
    values = ["2024-05-01 00:00:00", "2024-05-01 09:05:59", "14:30:00.000Z", "noon", "", None]
    assert column(spark, values, hhmm_time("v")) == ["0000", "0905", "1430", "", "", ""]


@pytest.mark.parametrize(
    "value, s, c", [(" select", "Y", ""), ("Curated", "", "Y"), (None, "", ""), ("", "", ""), ("x", "", "")]
)
def test_initial_flag(spark, value, s, c):
    assert column(spark, [value], initial_flag("v", "S")) == [s]
    assert column(spark, [value], initial_flag("v", "c")) == [c]


def test_fill_blank_leaves_other_types(spark):
    row = fill_blank(spark.createDataFrame([(None, None)], "s string, n int")).first()
    assert (row["s"], row["n"]) == ("", None)


def test_concat_phone_parts(spark):
    values = [
        ("1.0", "0412", "5551234567"),
        (None, None, None),
        ("1", None, "5.551234567E9"),
        ("+1", "x", "99999999999999999999.0"),
        ("1e2", "1.", "007"),
        ("617.5551234", "55.0", "1.5"),
    ]
    want = ["104125551234567", "", "15551234567", "+1x99999999999999999999.0", "1001007", "617.5551234551.5"]
    expression = concat_phone_parts("a", "b", "c")
    assert column(spark, values, expression, "a string, b string, c string") == want


def test_a_composed_number_carries_its_code(spark):
    values = [("49.0", "30", "123456"), ("+49", "30", "1"), ("", "30", "1"), (None, None, None), ("x", "1", "2")]
    expression = concat_phone_parts("b", "c", country="a")
    assert column(spark, values, expression, "a string, b string, c string") == ["+4930123456", "+49301", "301", "", "12"]


def test_concat_phone_parts_of_numbers(spark):
    values = [(1, 5551234567.0), (None, 12.0)]
    expression = concat_phone_parts("a", "b")
    assert column(spark, values, expression, "a int, b double") == ["15551234567", "12"]


def test_strip_special(spark):
    values = ["+1 (617) 555-1234", "(+)44+20", "5+5", "++7", "", "abc", None]
    assert column(spark, values, strip_special("v")) == ["16175551234", "4420", "55", "7", "", "", None]
    kept = ["+16175551234", "+4420", "55", "+7", "", "", None]
    assert column(spark, values, strip_special("v", keep_plus=True)) == kept


US, GB = ("1", "1", 10, 10), ("44", "0", 9, 10)


PHONES = [
    ("(617) 555-1234", US, "+16175551234"),
    ("1 617 555 1234", US, "+16175551234"),
    ("+1 617 555 1234", US, "+16175551234"),
    ("001 617 555 1234", US, "+16175551234"),
    ("020 7946 0000", GB, "+442079460000"),
    ("+44 (0)20 7946 0000", GB, "+442079460000"),
    ("0044 20 7946 0000", GB, "+442079460000"),
    ("44 20 7946 0000", GB, "+442079460000"),
    ("+49 30 123456", GB, "+4930123456"),
    ("+49 30", GB, None),
    ("+4930123456789012", GB, None),
    ("555-1234", US, None),
    ("61755512345", US, None),
    ("", US, None),
    ("ext.", US, None),
    (None, US, None),
    ("(617) 555-1234", (None, None, None, None), None),
    ("+49 30 123456", (None, None, None, None), None),
    ("617 555 1234", ("1", None, 10, 10), "+16175551234"),
]


def test_normalize_phones(spark):
    data = [(i, number, *plan) for i, (number, plan, _) in enumerate(PHONES)]
    df = spark.createDataFrame(
        data, "i int, v string, country_code string, trunk_prefix string, min_len int, max_len int"
    )
    done = normalize_phones(df, {"out": "v"})
    assert done.columns == [*df.columns, "out"]
    got = [r["out"] for r in done.orderBy("i").collect()]
    assert got == [want for _, _, want in PHONES]


def test_last_digits(spark):
    values = ["+16175551234", "12345", "123456", "", None]
    assert column(spark, values, last_digits("v")) == ["551234", None, "123456", None, None]
    assert column(spark, values, last_digits("v", 4)) == ["1234", "2345", "3456", None, None]


CODES = [("aa-123", "AA", "BOS"), ("AA", "aa", ""), ("aabos9", "AA", "bos"), ("9", None, None), (" - ", "AA", "BOS"), (None, "AA", "B")]


def test_property_code_strip(spark):
    got = column(spark, CODES, property_code("v", "b", "c"), "v string, b string, c string")
    assert got == ["123", "AA", "9", "9", None, None]


def test_property_code_prefix(spark):
    got = column(spark, CODES, property_code("v", "b", "c", "prefix"), "v string, b string, c string")
    assert got == ["AABOSAA123", "AA", "AABOSAABOS9", "9", None, None]


def test_property_code_rejects_an_unknown_mode(spark):
    with pytest.raises(ValueError):
        property_code("v", mode="guess")


def test_standardize_property_codes_keeps_or_overwrites(spark):
    df = spark.createDataFrame([("aa-1", "AA")], "code string, brand string")
    config = {"code": {"brand_col": "brand", "city_col": None}}
    kept = standardize_property_codes(df, config)
    assert kept.first().asDict() == {"code": "aa-1", "brand": "AA", "code_standardized": "1"}
    over = standardize_property_codes(df, config, overwrite=True)
    assert over.first().asDict() == {"code": "1", "brand": "AA"}
