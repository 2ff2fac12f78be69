import hashlib

from pyspark.sql import functions as F

from braidlake.functions import casts, dates, keys, text
from tests.conftest import d


def one(spark, expr, value, type_="string"):
    return spark.createDataFrame([(value,)], f"c {type_}").select(expr).first()[0]


def many(spark, expr, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {type_}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_identifiers(spark):
    raw = ["123.456-78", "00000000-11", "", None, "ab-1"]
    assert many(spark, text.digits_only("c"), raw) == ["12345678", "0000000011", "", None, "1"]
    assert many(spark, text.normalize_id("c"), raw) == ["12345678", "-1", "-1", "-1", "1"]
    assert many(spark, text.pad_id("c", 6), ["a1", "12345678", None]) == ["0000A1", "12345678", None]
    assert many(spark, text.strip_leading_zeros("c"), ["000", "0012-3", "0"]) == ["0", "123", "0"]
    assert one(spark, text.document_mask("c"), "12345678901") == "123.456.789-01"
    assert many(spark, text.blank_to_null("c"), [" ", "", "x", None]) == [None, None, "x", None]


def test_phones(spark):
    df = spark.createDataFrame(
        [("12345678",), ("1112345678",), ("011123456789"[:12],), ("912345678",), ("11912345678",),
         ("0119123456789",), ("123",), (None,)], "c string",
    )
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in text.split_phone("c").items()]).collect()]
    assert got == [
        (None, "12345678", None, None), ("11", "12345678", None, None),
        ("11", "23456789", None, None), (None, None, None, "912345678"),
        (None, None, "11", "912345678"), (None, None, "11", "123456789"),
        (None, None, None, None), (None, None, None, None),
    ]


def test_amounts_and_composite_ids(spark):
    assert [str(x) for x in many(spark, text.implied_decimal_text("c"), ["12345", "5", "-7"])] == [
        "123.45", "0.05", "-0.07",
    ]
    assert many(spark, text.implied_decimal_text("c"), ["x1", None]) == [None, None]
    row = spark.createDataFrame([("7", "42", None)], "a string, b string, c string").select(
        text.pad_concat(["a", "b"], [2, 4]), text.pad_concat(["a", "c"], [2, 4])
    ).first()
    assert tuple(row) == ("070042", None)


def test_codes_places_and_words(spark):
    codes = text.extract_code("c")
    assert many(spark, codes["code"], ["BL-1-02 x", "ZZ-1-02", None]) == ["BL", None, None]
    assert many(spark, codes["impact"], ["SF-7-11", "SF-7-1"]) == ["7", None]
    places = [
        ("BR01", "AA-12-X", "12000", "12000"), ("BR01", "AA- -C9", " C9", " C9"),
        ("BR01", "AA", None, None), ("AC01", "ABC-77-Q", "77000", "77000"),
        ("AC01", None, None, None), ("AC01", "X-1-AREA-LIN5", "AREA", "LIN5"),
        ("AC01", "X-1-AREA-L-55", "AREA", "L55"), ("AC01", "X-1-AREA-L12", "AREA", "L12"),
        ("AC01", "X-1-AREA-Z", "AREA", None), ("AC01", "X-1", None, None),
    ]
    df = spark.createDataFrame([(i, p, x) for i, (p, x, _, _) in enumerate(places)], "i int, p string, x string")
    parsed = text.parse_location("x", "p")
    got = [tuple(r)[1:] for r in df.select("i", parsed["area"], parsed["subarea"]).orderBy("i").collect()]
    assert got == [(a, s) for _, _, a, s in places]
    whole = text.contains_any_word("c", ["CONF"], whole=True)
    assert many(spark, whole, ["REL CONF", "RECONF", None]) == [True, False, False]
    assert one(spark, text.fold_accents("c"), "  São João ñ") == "SAO JOAO N"


def test_dates_and_times(spark):
    raw = ["20240229", "00000000", "0", "20249999", "x", None]
    assert many(spark, dates.clean_date("c"), raw) == [d("2024-02-29"), None, None, None, None, None]
    assert many(spark, dates.date_key("c"), raw) == [20240229, -1, -1, 20249999, -1, -1]
    assert many(spark, dates.clean_time("c"), ["123456", "000000", None]) == ["12:34:56", None, None]
    assert many(spark, dates.time_key("c"), ["123456", "000000", None]) == [1234, -1, -1]


def test_casts_never_raise(spark):
    assert many(spark, casts.safe_int("c"), [" 12 ", "1e3", "99999999999", "", None]) == [
        12, None, None, None, None,
    ]
    got = many(spark, casts.safe_cast("c", "decimal(5,2)"), ["1.5", "x", "123456"])
    assert [str(x) for x in got] == ["1.50", "None", "None"]
    assert many(spark, casts.safe_cast("c", "date"), ["2024-02-30", "2024-02-01", "soon"]) == [
        None, d("2024-02-01"), None,
    ]


def test_keys(spark):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    df = spark.createDataFrame([("a", None, 3), ("a", "b", 3)], "x string, y string, z int")
    assert [r[0] for r in df.select(keys.fingerprint(["x", "y", "z"], upper=True)).collect()] == [
        md5("A3"), md5("AB3"),
    ]
    assert one(spark, keys.fingerprint(["c", F.lit("x")], sep="|"), None) == md5("|x")
    assert many(spark, keys.hash_key(["c"]), [None])[0] == -1
    assert all(v >= 0 for v in many(spark, keys.hash_key(["c"]), [str(i) for i in range(200)]))
    same = keys.differs_by_sentinel(F.col("c"), F.lit(""))
    assert many(spark, same, [None, "", "x"]) == [False, False, True]
    filled = keys.unknown_member(df, {"y": "XX"})
    assert [r.y for r in filled.collect()] == ["XX", "b"]


def test_long_negative_text_is_not_cut(spark):
    long = "0" * 70 + "12345"
    got = many(spark, text.implied_decimal_text("c", precision=38), ["-" + long, long])
    assert [str(x) for x in got] == ["-123.45", "123.45"]


ODD = [
    "1", " 1 ", "\t1\n", "+1", "-1", "1.", ".5", "1.5", "1e3", "1E-2", "1.5d", "1f", "0x1p3", "NaN", "nan",
    "Infinity", "-inf", "+Infinity", "abc", "", " ", "1 2", "--1", "2024", "2024-2", "2024-02-30", "2024-2-3",
    " 2024-02-03 ", "2024-02-03T", "2024-02-03 10", "2024-02-03T12:30:00Z", "T12:30:00", "12:30:00", "-2024-01-01",
    "+2024-01-01", "12024-01-01", "now", "today", "\u20031\u2003", "\u0661\u0662", "\x011\x02",
]


def test_guarded_casts_accept_what_plain_ones_accept(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "c string")
    types = ["tinyint", "int", "bigint", "decimal(10,3)", "float", "double", "date", "timestamp_ntz"]
    for to in types:
        both = df.select("c", casts.safe_cast("c", to).cast("string"), F.col("c").try_cast(to).cast("string"))
        for row in both.collect():
            assert row[1] == row[2], (to, row)
