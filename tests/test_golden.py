"""Golden rows of the conformers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate import functions as fn
from stellate.operators.fuzzy import resolve_former
from stellate.plans import geography
from stellate.operators.labels import country_label, format_location, standardise_labels
from stellate.operators.shape import sanitise_columns, sanitise_name

COUNTRY = [
    ("  'AFGHANISTAN'", "Afghanistan"),
    ("  'ANTIGUA-BARBUDA'", "Antigua-Barbuda"),
    ("  'INVALID: USSR'", "USSR"),
    ("  'WEST INDIES (FRENCH)'", "France"),
    ("  'MAYOTTE (AFRICA - FRENCH)'", "Mayotte"),
    ("  'INVALID: CANTON AND ENDERBURY ISLS'", "Canton And Enderbury Islands"),
    ("  'INVALID: JOHNSON ISLAND'", "Johnston Island"),
    ("  'COCOS ISLANDS'", "Cocos (Keeling) Islands"),
    ("  'KAMPUCHEA'", "Cambodia"),
    ("  'No Country Code (54)'", "No Country Code"),
    ("  'ST. LUCIA'", "Saint Lucia"),
    ("  'LAOS'", "Lao People's Democratic Republic"),
    (None, None),
]

PORT = [
    ("ALCAN, AK", "Alcan, AK"),
    ("ASPEN, CO #ARPT", "Aspen, CO"),
    ("ROGERS ARPT, AR", "Rogers , AR"),
    ("REGIONAL ARPT - HORSEHEAD, NY", "Regional  - Horsehead, NY"),
    ("VIEQUES-ARPT, PR", "Vieques, PR"),
    ("DERBY LINE, VT (I-91)", "Derby Line, VT"),
    ("PASO DEL NORTE,TX", "Paso Del Norte, TX"),
    ("MARIPOSA AZ", "Mariposa, AZ"),
    ("PACIFIC, HWY. STATION, CA", "Pacific, CA"),
    ("HULL FIELD, SUGAR LAND ARPT, TX", "Hull Field, TX"),
    ("BOGOTA, EL DORADO #ARPT, COLOMBIA", "Bogota, Colombia"),
    ("ARUBA, NETH ANTILLES", "Aruba, Bonaire, Sint Eustatius and Saba"),
    ("Abu Dhabi", "Abu Dhabi, United Arab Emirates"),
    ("KIEV, USSR", "Kiev, Russian Federation"),
    ("UNKNOWN POE", "Unknown code"),
    ("LIMBO, X", None),
    ("LIMBO, ARPT", None),
    (None, None),
]

NAMES = [
    "Afghanistan",
    "Bolivia (Plurinational State of)",
    "Bonaire, Sint Eustatius and Saba",
    "Colombia",
    "Kiribati",
    "Myanmar",
    "Russian Federation",
    "United Arab Emirates",
]

FORMER = [
    ("USSR", "Russian Federation"),
    ("Burma", "Myanmar"),
    ("Canton and Enderbury Islands", "Kiribati"),
    ("Netherlands Antilles", "[Bonaire, Sint Eustatius and Saba, Curacao, Sint Maarten]"),
]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "reference_country string")


@pytest.fixture(scope="module")
def former(spark):
    return spark.createDataFrame(FORMER, "former_country_name string, new_country_names string")


def test_column_names():
    assert sanitise_name("Latitude (average)") == "latitude_average"
    assert sanitise_name("Alpha-2 code") == "alpha-2_code"
    assert sanitise_name("Foreign-born") == "foreign-born"


def test_colliding_column_names_raise(spark):
    with pytest.raises(ValueError, match="collide"):
        sanitise_columns(spark.range(1).selectExpr("1 AS `A b`", "2 AS `a_B`"))


def test_epoch_days(spark):
    days = spark.createDataFrame([(20574.0,), (0.0,), (None,)], "d double")
    plain = [r[0] for r in days.select(fn.epoch_days_to_date("d")).collect()]
    filled = [r[0] for r in days.select(fn.epoch_days_to_date("d", null_as=0)).collect()]
    assert plain == [dt.date(2016, 4, 30), dt.date(1960, 1, 1), None]
    assert filled == [dt.date(2016, 4, 30), dt.date(1960, 1, 1), dt.date(1960, 1, 1)]


def test_date_parts(spark):
    row = spark.sql("SELECT DATE '2016-01-03' AS d").select(*fn.date_parts("d").values()).first()
    assert tuple(row) == (3, 1, 53)


def test_hemisphere(spark):
    text = spark.createDataFrame([("57.05N",), ("10.33W",), ("1S",), ("",), (None,), ("N",), ("x.yE",)], "c string")
    assert [r[0] for r in text.select(fn.parse_hemisphere("c")).collect()] == [57.05, -10.33, -1.0, None, None, None, None]


def test_code_and_label(spark):
    text = spark.createDataFrame([("USAVO: Avoca, NY",), ("no separator",)], "c string")
    assert [tuple(r) for r in text.select(*fn.split_code_label("c")).collect()] == [("AVO", "Avoca, NY"), (" se", None)]


def test_title_case(spark):
    words = ["ANTIGUA-BARBUDA (X)", "O'HARE st. x2y", "CÔTE D'IVOIRE", ""]
    df = spark.createDataFrame([(w,) for w in words], "c string")
    assert [r[0] for r in df.select(fn.title_case("c")).collect()] == [w.title() for w in words]


def test_country_labels(spark):
    df = spark.createDataFrame(COUNTRY, "raw string, want string")
    got = df.withColumn("got", country_label("raw")).where(~F.col("got").eqNullSafe(F.col("want"))).collect()
    assert got == []


def test_port_labels(spark, names, former):
    df = spark.createDataFrame(PORT, "raw string, want string")
    out = format_location(df, "raw", names, "reference_country", former, out="got")
    assert out.count() == len(PORT)
    assert out.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_former_names(spark, former):
    df = spark.createDataFrame([("USSR",), ("burma",), ("Canton And Enderbury Islands",), ("Chad",), (None,)], "c string")
    got = {r.c: r.now for r in resolve_former(df, "c", former, out="now").collect()}
    assert got == {
        "USSR": "Russian Federation",
        "burma": "Myanmar",
        "Canton And Enderbury Islands": "Kiribati",
        "Chad": "Chad",
        None: None,
    }


def test_standard_names(spark, names, former):
    raw = ["  'INVALID: USSR'", "  'BURMA'", "  'BOLIVIA'", "  'AFGANISTAN'", "  'No Country Code (54)'", None]
    df = spark.createDataFrame([(r,) for r in raw * 3], "c string")
    out = standardise_labels(df, "c", "name", names, "reference_country", former)
    assert out.count() == len(raw) * 3
    assert {r.c: r.name for r in out.collect()} == dict(
        zip(
            raw,
            ["Russian Federation", "Myanmar", "Bolivia (Plurinational State of)", "Afghanistan", "No match found", None],
        )
    )


SUCCESSORS = [
    ("Czechoslovakia", ["Czechia", "Slovakia"], "Czechia"),
    ("French Southern and Antarctic Territories", ["Antartica", "French Southern Territories"], "French Southern Territories"),
    ("Netherlands Antilles", ["Bonaire", "Sint Eustatius and Saba", "Curacao", "Sint Maarten"], "Bonaire, Sint Eustatius and Saba"),
    ("Neutral Zone", ["Iraq", "Saudi Arabia"], "Iraq"),
    (
        "Pacific Islands (Trust Territory)",
        ["Marshall Islands", "Micronesia (Federared States of)", "Northern Mariana Islands", "Palau"],
        "Marshall Islands",
    ),
    ("Serbia and Montenegro", ["Montenegro", "Serbia"], "Montenegro"),
]


def test_several_successors(spark):
    """Each successor is compared by itself; a name that holds a comma is put together again."""
    cells = [(name, f"[{', '.join(now)}]") for name, now, _ in SUCCESSORS] + [("Burma", "Myanmar")]
    former = geography.former_countries(spark.createDataFrame(cells, "former_country_name string, new_country_names string"))
    assert [r.successors for r in former.collect()] == [now for _, now, _ in SUCCESSORS] + [["Myanmar"]]
    wanted = {want for *_, want in SUCCESSORS} | {"Antarctica", "Slovakia", "Serbia", "Saudi Arabia", "Palau", "Myanmar", "Chad"}
    names = spark.createDataFrame([(n,) for n in sorted(wanted)], "reference_country string")
    asked = [name.upper() for name, *_ in SUCCESSORS] + ["burma", "Chad", "Xyzzy"]
    out = standardise_labels(spark.createDataFrame([(a,) for a in asked], "c string"), "c", "name", names, "reference_country", former, clean=lambda c: c)
    got = {r.c: r.name for r in out.collect()}
    assert got == {name.upper(): want for name, _, want in SUCCESSORS} | {"burma": "Myanmar", "Chad": "Chad", "Xyzzy": "No match found"}


def test_the_nearest_successor_wins(spark):
    former = spark.createDataFrame([("Old", "[Nowhere, Myanmer]", ["Nowhere", "Myanmer"])], "a string, b string, successors array<string>")
    names = spark.createDataFrame([("Myanmar",), ("Chad",)], "n string")
    out = standardise_labels(spark.createDataFrame([("old",)], "c string"), "c", "name", names, "n", former, clean=lambda c: c)
    assert out.collect() == [("old", "Myanmar")]
