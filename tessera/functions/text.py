"""Name and address normalisation as column expressions.

All of it stays in the JVM. Only scripts beyond Latin need `transliterated`, an Arrow UDF, which
a caller adds by asking for `scripts=True`.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from . import tables


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


# Consonant after consonant of U+0915..U+0939, the vowels and the signs, by their sounds.
_DEVANAGARI = dict(
    zip(
        "अआइईउऊऋएऐओऔऑऍकखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह",
        "a aa i ii u uu r e ai o au o e k kh g gh n c ch j jh n tt tth dd ddh nn t th d dh n p ph b bh m y r l v sh ss s h".split(),
        strict=True,
    )
)
_SIGNS = dict(zip("ािीुूृेैोौॉॅंँः़्", "aa i ii u uu r e ai o au o e N N h  ".split(" "), strict=False))
_DIGITS = {chr(0x966 + i): str(i) for i in range(10)}
_CONSONANTS = frozenset("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह")


def to_ascii(text: str) -> str:
    """Latin accents stripped, Devanagari by sound, anything else dropped."""
    out = []
    text = unicodedata.normalize("NFKC", text)
    for i, c in enumerate(text):
        if c.isascii():
            out.append(c)
        elif c in _DEVANAGARI:
            following = text[i + 1] if i + 1 < len(text) else " "
            # A consonant carries a short vowel inside a word, unless a sign takes its place.
            inner = c in _CONSONANTS and following in _DEVANAGARI
            out.append(_DEVANAGARI[c] + ("a" if inner else ""))
        elif c in _SIGNS or c in _DIGITS:
            out.append(_SIGNS.get(c, _DIGITS.get(c, "")))
        else:
            double = dict(tables.DOUBLE_LETTERS).get(c)
            out.append(double if double is not None else "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii()))
    return "".join(out)


@pandas_udf(StringType())
def transliterated(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else to_ascii(x))


def fold(text: Column, scripts: bool = False) -> Column:
    """Lower case without accents, white space squeezed; null is empty."""
    text = F.coalesce(text, F.lit(""))
    beyond = text.rlike(r"[^\x00-\x7F]")
    plain = F.regexp_replace(text, r"[̀-ͯ]", "")
    for a, b in tables.DOUBLE_LETTERS:
        plain = F.replace(plain, F.lit(a), F.lit(b))
    plain = F.translate(plain, *tables.latin_letters())
    if scripts:
        plain = F.when(plain.rlike(r"[^\x00-\x7F]"), transliterated(F.when(beyond, text))).otherwise(plain)
    # What a transliteration writes differently from Latin spelling; plain ASCII is left alone.
    fixed = plain
    for a, b in (("N", "n"), ("ph", "f"), ("PH", "F")):
        fixed = F.replace(fixed, F.lit(a), F.lit(b))
    ascii_text = F.when(beyond, F.regexp_replace(fixed, r"[^\x00-\x7F]", "")).otherwise(text)
    return F.trim(F.regexp_replace(F.lower(ascii_text), r"\s+", " "))


def strip_junk(text: Column) -> Column:
    """Without marks at the edges, then without one leading noise word."""
    bare = F.regexp_replace(text, f"^{tables.EDGE_CLASS}|{tables.EDGE_CLASS}$", "")
    return F.trim(F.regexp_replace(bare, tables.LEADING_NOISE, ""))


def _runs_once(text: Column) -> Column:
    return F.regexp_replace(text, r"(.)\1+", "$1")


def consonant_skeleton(text: Column) -> Column:
    return _runs_once(F.regexp_replace(F.replace(F.lower(text), F.lit("ph"), F.lit("f")), "[aeiou]|[^0-9a-z]", ""))


def vowel_squeeze(text: Column) -> Column:
    return _runs_once(F.regexp_replace(F.replace(F.lower(text), F.lit("ph"), F.lit("f")), "[^0-9a-z]", ""))


def words(text: Column) -> Column:
    """Runs of letters and digits."""
    return F.filter(F.split(text, "[^a-z0-9]+"), lambda t: t != "")


def legal_code(word: Column) -> Column:
    """Canonical legal form of a word, or null."""
    key = consonant_skeleton(word)
    by_skeleton = F.when((F.length(word) >= tables.LEGAL_WORD_MIN) & (F.length(key) >= tables.LEGAL_SKELETON_MIN), F.try_element_at(_map(tables.legal_skeletons()), key))
    return F.coalesce(F.try_element_at(_map(tables.legal_words()), word), by_skeleton)


def legal_class(code: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(tables.LEGAL_EQUAL), code), code)


def trade_name(folded: Column) -> Column:
    """What stands behind "doing business as": the longest such part, or the part before where it is empty."""
    parts = F.split(folded, tables.TRADE_NAME)
    right = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    longest = F.trim(F.aggregate(right, F.lit(""), lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc)))
    return F.when(F.size(parts) > 1, F.when(longest != "", longest).otherwise(F.element_at(parts, 1))).otherwise(folded)


def domain_stem(text: Column) -> Column:
    """The name in a web address, or null."""
    stem = F.regexp_extract(F.replace(text, F.lit(" "), F.lit("")), tables.DOMAIN, 1)
    return F.when(stem != "", F.replace(stem, F.lit("-"), F.lit(" ")))


def canon_address_word(word: Column) -> Column:
    """Canonical address word; '' drops it."""
    ordinal = F.regexp_extract(word, tables.ORDINAL_DIGITS, 1)
    return F.when(ordinal != "", ordinal).otherwise(F.coalesce(F.try_element_at(_map(tables.address_words()), word), word))


def postal_code(folded: Column) -> Column:
    """The first run of six digits, else of five, after joining codes written in two halves."""
    joined = F.regexp_replace(folded, tables.SPLIT_POSTAL, "$1$2")
    runs = F.regexp_extract_all(joined, F.lit("([0-9]+)"), 1)
    six, five = F.filter(runs, lambda r: F.length(r) == 6), F.filter(runs, lambda r: F.length(r) == 5)
    return F.coalesce(F.get(six, 0), F.get(five, 0), F.lit(""))


def house_number(folded: Column) -> Column:
    """The first word with a digit of the first component."""
    return F.coalesce(F.get(F.filter(words(F.split(folded, ",")[0]), lambda t: t.rlike("[0-9]")), 0), F.lit(""))


def with_name_parts(df: DataFrame, name: str = "business_name", scripts: bool = False) -> DataFrame:
    """Adds had_dba, is_domain, core (array), legal (sorted array), name_skel, name_squeeze, name_nospace."""
    step = df.withColumn("_f", fold(F.col(name), scripts))
    step = step.withColumn("had_dba", F.size(F.split("_f", tables.TRADE_NAME)) > 1).withColumn("_f", strip_junk(trade_name(F.col("_f"))))
    step = step.withColumn("_d", domain_stem(F.col("_f"))).withColumn("is_domain", F.col("_d").isNotNull())
    step = step.withColumn("_w", words(F.translate(F.coalesce("_d", "_f"), "&+", "  ")))
    step = step.withColumn("_c", F.transform("_w", lambda t: F.struct(t.alias("t"), legal_code(t).alias("c"))))
    step = step.withColumn("legal", F.array_sort(F.array_distinct(F.transform(F.filter("_c", lambda x: x["c"].isNotNull()), lambda x: legal_class(x["c"])))))
    step = step.withColumn("core", F.transform(F.filter("_c", lambda x: x["c"].isNull()), lambda x: x["t"]))
    step = step.withColumn("core", F.when(F.size("core") == 0, F.col("_w")).otherwise(F.col("core")))
    joined = F.array_join("core", " ")
    step = step.withColumn("name_skel", consonant_skeleton(joined)).withColumn("name_squeeze", vowel_squeeze(joined)).withColumn("name_nospace", F.array_join("core", ""))
    return step.drop("_f", "_d", "_w", "_c")


def with_address_parts(df: DataFrame, address: str = "business_address", scripts: bool = False) -> DataFrame:
    """Adds addr_tokens, addr_digits, addr_alpha (arrays), postal, house, addr_skel, addr_empty."""
    step = df.withColumn("_f", fold(F.col(address), scripts))
    step = step.withColumn("_f", F.when(F.col("_f").isin(tables.NO_ADDRESS), F.lit("")).otherwise(F.replace("_f", F.lit("<null>"), F.lit(" "))))
    step = step.withColumn("addr_empty", F.col("_f") == "").withColumn("postal", postal_code(F.col("_f"))).withColumn("house", house_number(F.col("_f")))
    step = step.withColumn("_t", F.filter(F.transform(words(F.col("_f")), canon_address_word), lambda t: t != ""))
    step = step.withColumn("addr_tokens", F.array_distinct("_t"))
    step = step.withColumn("addr_digits", F.filter("addr_tokens", lambda t: t.rlike("[0-9]")))
    step = step.withColumn("addr_alpha", F.filter("addr_tokens", lambda t: ~t.rlike("[0-9]") & (F.length(t) > 1)))
    step = step.withColumn("addr_skel", consonant_skeleton(F.array_join("addr_alpha", " ")))
    return step.drop("_f", "_t")


def with_aliases(df: DataFrame, name_map: dict[str, str] | None = None, address_map: dict[str, str] | None = None) -> DataFrame:
    """core and addr_alpha with aliases replaced; address words are made distinct again, names are not."""
    if name_map:
        lookup = _map(name_map)
        df = df.withColumn("core", F.transform("core", lambda t: F.coalesce(F.try_element_at(lookup, t), t)))
    if address_map:
        lookup_address = _map(address_map)
        df = df.withColumn("addr_alpha", F.array_distinct(F.transform("addr_alpha", lambda t: F.coalesce(F.try_element_at(lookup_address, t), t))))
    return df


def shingles(text: Column, size: int = 6, limit: int = 16) -> Column:
    """Substrings of `size`; if there are more than `limit`, that many evenly spread; short texts whole."""
    count = F.length(text) - (size - 1)
    starts = F.sequence(F.lit(0), F.least(F.lit(limit), F.greatest(count, F.lit(1))) - 1)
    spread = F.transform(starts, lambda i: F.substring(text, F.floor(i * F.greatest(count, F.lit(limit)) / F.lit(float(limit))).cast("int") + 1, F.lit(size)))
    return F.when(text == "", F.array().cast("array<string>")).when(F.length(text) <= size, F.array(text)).otherwise(spread)


def acronym(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.left(t, F.lit(1))), "")
