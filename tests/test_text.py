"""Normalisation: golden groups and corner cases."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import tables, text


def parts(spark, names, scripts=False):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, business_name string")
    return [r.asDict() for r in text.with_name_parts(df, scripts=scripts).orderBy("i").collect()]


def addresses(spark, values):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(values)], "i int, business_address string")
    return [r.asDict() for r in text.with_address_parts(df).orderBy("i").collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_trade_name_domain_and_noise(spark):
    trade, domain, junk, leading = parts(
        spark,
        ["Halonex dba Marnie Baynes Keystone Bnb Inc", "edwardshintzedougherty.com", "... THE MARNIE BAYNES KEYSTONE BNB INC", "M/s Finest (India) World Private Ltd"],
    )
    assert trade["had_dba"] and trade["core"] == ["marnie", "baynes", "keystone", "bnb"] and trade["legal"] == ["inc"]
    assert domain["is_domain"] and domain["name_nospace"] == "edwardshintzedougherty"
    assert junk["core"] == trade["core"] and junk["name_skel"] == trade["name_skel"]
    assert leading["core"] == ["finest", "india", "world"] and leading["legal"] == ["ltd"]


def test_only_legal_words_stay_core(spark):
    (row,) = parts(spark, ["Private Limited"])
    assert row["core"] == ["private", "limited"] and row["legal"] == ["ltd"]


def test_skeleton_collapses_over_vowels(spark):
    assert one(spark, text.consonant_skeleton(F.lit("ram marketing"))) == "rmrktng"
    assert one(spark, text.consonant_skeleton(F.lit("phuudds"))) == "fds"
    assert one(spark, text.vowel_squeeze(F.lit("raama maarketting"))) == "ramamarketing"


@pytest.mark.parametrize("word,code", [("palace", "plc"), ("tourist", "trust"), ("ace", None), ("limitteda", "ltd"), ("kompany", "co")])
def test_legal_by_skeleton(spark, word, code):
    assert one(spark, text.legal_code(F.lit(word))) == code


def test_addresses(spark):
    ordinal, pin, empty, null, blank, none = addresses(spark, ["541 FOURTEENTH SAINT, NEWPORT, OR", "Chennai - 600 094.", "", "<NULL>", "  ", None])
    assert ordinal["addr_tokens"] == ["541", "14", "st", "newport", "or"] and ordinal["house"] == "541"
    assert pin["postal"] == "600094"
    assert all(r["addr_empty"] and r["addr_tokens"] == [] and r["postal"] == "" for r in (empty, null, blank, none))


def test_component_order_does_not_matter(spark):
    a, b = addresses(spark, ["44 Goodrich Avenue, Auburn, ME", "ME, Auburn, 44 Goodrich Avenue"])
    assert sorted(a["addr_tokens"]) == sorted(b["addr_tokens"])


def test_accents_and_scripts(spark):
    a, b = parts(spark, ["Société Générale", "Societe Generale"])
    assert a["core"] == b["core"]
    latin, devanagari = parts(spark, ["ram marketing private limited", "राम मार्केटिंग प्राइवेट लिमिटेड"], scripts=True)
    assert latin["name_skel"] == devanagari["name_skel"] and devanagari["legal"] == ["ltd"]


def test_capital_n_of_plain_ascii_is_kept(spark):
    assert one(spark, text.fold(F.lit("NEW  DELHI "))) == "new delhi"


def test_shingles_are_spread(spark):
    s = "abcdefghijklmnopqrstuvwxyz0123456789"
    got = one(spark, text.shingles(F.lit(s)))
    assert len(got) == 16 and got[0] == s[:6] and got[8] == s[int(8 * 31 / 16) :][:6]
    assert one(spark, text.shingles(F.lit("abc"))) == ["abc"] and one(spark, text.shingles(F.lit(""))) == []


def test_address_words_precedence():
    words = tables.address_words()
    assert words["fourteenth"] == "14" and words["saint"] == "st" and words["near"] == "" and words["vii"] == "7" and words["fourty"] == "40"
