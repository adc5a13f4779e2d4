"""Pair features: 44 native columns, and 11 from one Arrow UDF, so that a pair crosses to Python once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.functions import fuzzy
from tessera.functions.text import acronym

#: Columns of the design matrix, in order.
FEATURES = (
    "block_score name_channel addr_channel cand_rank cand_count "
    "name_jaccard name_containment name_idf_cosine name_idf_containment name_shared_max_idf name_shared_sum_idf name_unshared_max_idf_q name_unshared_max_idf_c name_n_shared name_tok_count_q name_tok_count_c name_tok_count_diff "
    "name_ratio name_token_set name_token_sort name_partial name_jaro skel_ratio skel_prefix_eq skel_equal nospace_equal nospace_containment nospace_ratio acronym_match legal_agree legal_conflict legal_both_empty best_token_pair_ratio worst_shared_token_ratio "
    "addr_jaccard addr_containment addr_idf_cosine addr_shared_max_idf addr_n_shared addr_ratio addr_token_set digit_jaccard digit_containment digit_n_shared house_equal house_prefix_eq postal_equal postal_prefix3 both_have_postal addr_empty_q addr_empty_c addr_empty_any cross_name_in_addr cross_addr_in_name country_equal"
).split()


def idf_maps(store: DataFrame) -> DataFrame:
    """id, name_idf, addr_idf: each record's own tokens with their IDF over all records of its country."""
    sizes = store.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    out = store.select("id", "country")
    for side, tokens in (("name_idf", "core"), ("addr_idf", "addr_alpha")):
        each = store.select("id", "country", F.explode(F.array_distinct(tokens)).alias("token"))
        df = each.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df")).join(sizes, "country")
        weighed = df.select("country", "token", (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("w"))
        maps = each.join(weighed, ["country", "token"]).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("token", "w"))).alias(side))
        out = out.join(maps, "id", "left").withColumn(side, F.coalesce(side, F.create_map().cast("map<string,double>")))
    return out.drop("country")


def joined_pairs(cands: DataFrame, store: DataFrame, with_idf: bool = False) -> DataFrame:
    """cands with both records' views: q and c columns side by side."""
    side = store if not with_idf else store.join(idf_maps(store), "id")
    views = {"core": "n", "name_skel": "k", "name_nospace": "w", "legal": "l", "addr_alpha": "a", "addr_digits": "d", "postal": "p", "house": "h", "addr_tokens": "t"} | ({"name_idf": "ni", "addr_idf": "ai"} if with_idf else {})
    q = side.select(F.col("id").alias("q_id"), F.col("country"), *[F.col(v).alias(f"q{x}") for v, x in views.items()])
    c = side.select(F.col("id").alias("c_id"), F.col("src"), F.col("country").alias("c_country"), *[F.col(v).alias(f"c{x}") for v, x in views.items()])
    return cands.join(q, "q_id").join(c, "c_id")


def _sizes(a: str, b: str) -> tuple[Column, Column, Column, Column]:
    return F.size(F.array_distinct(a)), F.size(F.array_distinct(b)), F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))


def _share(x: Column, of: Column) -> Column:
    return F.when(of == 0, F.lit(0.0)).otherwise(x / of)


def bag(prefix: str, a: str, b: str) -> dict[str, Column]:
    na, nb, both, either = _sizes(a, b)
    least = F.least(na, nb)
    return {f"{prefix}_jaccard": _share(both, either), f"{prefix}_containment": both / F.when(least == 0, 1).otherwise(least), f"{prefix}_n_shared": both}


def name_bag() -> dict[str, Column]:
    na, nb, _, _ = _sizes("qn", "cn")
    return bag("name", "qn", "cn") | {"name_tok_count_q": na, "name_tok_count_c": nb, "name_tok_count_diff": F.abs(na - nb)}


def address_bag() -> dict[str, Column]:
    return bag("addr", "qa", "ca")


def digits() -> dict[str, Column]:
    return bag("digit", "qd", "cd")


def _weight(weights: Column, token: Column) -> Column:
    return F.coalesce(F.try_element_at(weights, token), F.lit(1.0))


def _total(tokens: Column, weights: Column, power: int = 1) -> Column:
    # Sorted, so that the sum has one order.
    ordered = F.array_sort(tokens)
    return F.aggregate(ordered, F.lit(0.0), lambda acc, t: acc + (_weight(weights, t) if power == 1 else _weight(weights, t) * _weight(weights, t)))


def _largest(tokens: Column, weights: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(tokens, lambda t: _weight(weights, t))), F.lit(0.0))


def idf_features() -> dict[str, Column]:
    qn, cn, qi, ci = F.array_distinct("qn"), F.array_distinct("cn"), F.col("qni"), F.col("cni")
    both = F.array_intersect("qn", "cn")
    norms = F.sqrt(_total(qn, qi, 2)) * F.sqrt(_total(cn, ci, 2))
    shared_address = F.array_intersect("qa", "ca")
    address_norms = F.sqrt(_total(F.array_distinct("qa"), F.col("qai"), 2)) * F.sqrt(_total(F.array_distinct("ca"), F.col("cai"), 2))
    return {
        "name_idf_cosine": _share(_total(both, qi, 2), norms),
        "name_idf_containment": _share(_total(both, qi), F.least(_total(qn, qi), _total(cn, ci))),
        "name_shared_max_idf": _largest(both, qi),
        "name_shared_sum_idf": _total(both, qi),
        "name_unshared_max_idf_q": _largest(F.array_except("qn", "cn"), qi),
        "name_unshared_max_idf_c": _largest(F.array_except("cn", "qn"), ci),
        "addr_idf_cosine": _share(_total(shared_address, F.col("qai"), 2), address_norms),
        "addr_shared_max_idf": _largest(shared_address, F.col("qai")),
    }


def _same(a: str, b: str) -> Column:
    return ((F.col(a) != "") & (F.col(a) == F.col(b))).cast("int")


def _same_start(a: str, b: str, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return ((F.col(a) != "") & (F.col(b) != "") & (F.left(a, n) == F.left(b, n))).cast("int")


def structural() -> dict[str, Column]:
    shorter = F.when(F.length("qw") <= F.length("cw"), F.col("qw")).otherwise(F.col("cw"))
    longer = F.when(F.length("qw") <= F.length("cw"), F.col("cw")).otherwise(F.col("qw"))
    qa, ca = acronym(F.col("qn")), acronym(F.col("cn"))
    both = (F.size("qn") > 0) & (F.size("cn") > 0)
    return {
        "skel_equal": _same("qk", "ck"),
        "skel_prefix_eq": _same_start("qk", "ck", F.least(F.lit(6), F.length("qk"), F.length("ck"))),
        "nospace_equal": _same("qw", "cw"),
        "nospace_containment": ((F.col("qw") != "") & (F.col("cw") != "") & F.contains(longer, shorter)).cast("int"),
        "acronym_match": (both & ((qa == F.col("cw")) | (ca == F.col("qw")) | (qa == ca))).cast("int"),
        "legal_agree": F.arrays_overlap("ql", "cl").cast("int"),
        "legal_conflict": ((F.size("ql") > 0) & (F.size("cl") > 0) & ~F.arrays_overlap("ql", "cl")).cast("int"),
        "legal_both_empty": ((F.size("ql") == 0) & (F.size("cl") == 0)).cast("int"),
        "house_equal": _same("qh", "ch"),
        "house_prefix_eq": _same_start("qh", "ch", 2),
        "postal_equal": _same("qp", "cp"),
        "postal_prefix3": _same_start("qp", "cp", 3),
        "both_have_postal": ((F.col("qp") != "") & (F.col("cp") != "")).cast("int"),
    }


def missing() -> dict[str, Column]:
    q, c = F.size("qa") == 0, F.size("ca") == 0
    return {"addr_empty_q": q.cast("int"), "addr_empty_c": c.cast("int"), "addr_empty_any": (q | c).cast("int")}


def cross() -> dict[str, Column]:
    na, nb, _, _ = _sizes("qn", "cn")
    return {"cross_name_in_addr": _share(F.size(F.array_intersect("qn", "ca")), na), "cross_addr_in_name": _share(F.size(F.array_intersect("qa", "cn")), nb)}


_FUZZY = "name_ratio name_token_set name_token_sort name_partial name_jaro skel_ratio nospace_ratio addr_ratio addr_token_set best_token_pair_ratio worst_shared_token_ratio".split()


@pandas_udf(StructType([StructField(f, DoubleType()) for f in _FUZZY]))
def fuzzy_features(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """Of (core, core, skeleton, skeleton, nospace, nospace, address, address)."""
    for qn, cn, qk, ck, qw, cw, qa, ca in batches:
        rows = []
        for a, b, ak, bk, aw, bw, aa, ba in zip(qn, cn, qk, ck, qw, cw, qa, ca, strict=True):
            name_a, name_b, addr_a, addr_b = " ".join(a), " ".join(b), " ".join(aa), " ".join(ba)
            best, worst = fuzzy.alignment(list(a), list(b))
            rows.append(
                (
                    fuzzy.ratio(name_a, name_b), fuzzy.token_set(name_a, name_b), fuzzy.token_sort(name_a, name_b), fuzzy.partial(name_a, name_b), fuzzy.jaro_winkler(name_a, name_b),
                    fuzzy.ratio(ak, bk), fuzzy.ratio(aw, bw), fuzzy.ratio(addr_a, addr_b), fuzzy.token_set(addr_a, addr_b), best, worst,
                )
            )
        yield pd.DataFrame(rows, columns=_FUZZY)


def with_fuzzy(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("_z", fuzzy_features("qn", "cn", "qk", "ck", "qw", "cw", "qa", "ca")).select("*", "_z.*").drop("_z")


def design_matrix(cands: DataFrame, store: DataFrame) -> DataFrame:
    """q_id, c_id, src and all 55 features as doubles; cands has score, mask, cand_rank, cand_count."""
    pairs = with_fuzzy(joined_pairs(cands, store, with_idf=True))
    made = name_bag() | idf_features() | address_bag() | digits() | structural() | missing() | cross()
    made |= {
        "block_score": F.col("score"),
        "name_channel": F.col("mask").bitwiseAND(1),
        "addr_channel": F.shiftright(F.col("mask"), 1).bitwiseAND(1),
        "country_equal": (F.col("country") == F.col("c_country")).cast("int"),
    }
    kept = ["label"] if "label" in cands.columns else []
    return pairs.select("q_id", "c_id", "src", *kept, *[F.coalesce(made.get(f, F.col(f)).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])
