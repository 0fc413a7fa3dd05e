import datetime
import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyline.functions import dates, names, numeric, odds


def values(frame, ddl_type, data, build):
    df = frame([{"x": v, "i": i} for i, v in enumerate(data)], f"x {ddl_type}, i int")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


def test_implied_probability(frame):
    got = values(frame, "double", [-120.0, 100.0, 150.0, 0.0, None], odds.implied_probability)
    assert got == [pytest.approx(120 / 220), 0.5, 0.4, 1.0, None]


def test_names(frame):
    raw = [" Núñez,  José ", "Jacob deGrom", "J.D. O'Neil-Smith", None, "a,b,c"]
    assert values(frame, "string", raw, names.entity_name) == [
        "jose nunez", "jacob degrom", "j.d. o'neil-smith", "", "b,c a",
    ]
    assert values(frame, "string", raw, names.quote_name) == [
        "núñez,  josé", "jacob degrom", "jd oneil smith", "", "a,b,c",
    ]
    assert values(frame, "string", raw, names.slate_name)[2] == "JD ONeil Smith"
    assert values(frame, "string", [" nyy ", None], names.group_code) == ["NYY", ""]
    wide = ["ﬁn Ａｂ é"]
    assert values(frame, "string", wide, lambda c: names.entity_name(c, exact=True)) == ["fin ab e"]


def test_canonical_key_joins_both_spellings(frame):
    got = values(frame, "string", ["Peña, Jeremy", "Jeremy Pena", "jeremy peña"], names.canonical_name)
    assert set(got) == {"jeremy pena"}


def test_ledger_scalars(frame):
    text = ["+120", "-110", "", "even", "0", None, " 105 "]
    assert values(frame, "string", text, odds.parse_odds) == [120.0, -110.0, None, None, None, None, 105.0]
    assert values(frame, "double", [120.0, -110.7, None], odds.format_odds) == ["+120", "-110", ""]
    spelled = ["w", " WIN", "Loss", "push", "void", None]
    assert values(frame, "string", spelled, odds.settled_result) == ["W", "W", "L", "Push", "", ""]


def test_bands_are_right_closed(frame):
    got = values(frame, "double", [None, 4.5, 4.6, 5.5, 6.5, 7.5, 7.6], odds.banded)
    assert got == ["unknown", "<=4.5", "4.5-5.5", "4.5-5.5", "5.5-6.5", "6.5-7.5", "7.5+"]


def test_missing_numbers(frame):
    assert values(frame, "double", [float("nan"), 1.0, None], numeric.nan_to_null) == [None, 1.0, None]
    assert values(frame, "double", [float("inf"), float("nan"), 2.0], numeric.finite_or_null) == [None, None, 2.0]
    assert values(frame, "double", [None, float("nan"), -1.0, 2.0], numeric.at_least_zero) == [0.0, 0.0, 0.0, 2.0]
    assert values(frame, "string", [" 1.5e1 ", "1.0d", "nan", ""], numeric.to_number) == [15.0, None, None, None]


def test_instants_without_offset_are_utc(spark, frame):
    raw = ["2025-08-02T23:10:00Z", "2025-08-02 23:10:00", "2025-08-02", "soon", "", "2025-08-03T01:10:00+02:00"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(frame, "string", raw, lambda c: F.unix_seconds(dates.to_instant(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    at = int(datetime.datetime(2025, 8, 2, 23, 10, tzinfo=datetime.UTC).timestamp())
    midnight = int(datetime.datetime(2025, 8, 2, tzinfo=datetime.UTC).timestamp())
    assert got == [at, at, midnight, None, None, at]


def test_every_letter_of_the_plane_folds_as_unicode_says(spark):
    letters = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(letters[i : i + 40]) for i in range(0, len(letters), 40)] + ["ﬁn Straße 한국 ½ …", None, "", "plain"]
    df = spark.createDataFrame([(t,) for t in lines], "t string")
    got = df.select("t", names.fold_accents(F.col("t")).alias("own"), names.fold_accents(F.col("t"), exact=True).alias("exact"))
    rows = got.collect()
    assert all(r["own"] == r["exact"] for r in rows)
    folded = {r["t"]: r["own"] for r in rows}
    assert folded["ﬁn Straße 한국 ½ …"] == "fin Straße " + "".join(unicodedata.normalize("NFKD", "한국")) + " 1⁄2 ..."
