"""Every entity-resolution query by name, with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config
from tessera.functions import fuzzy, text
from tessera.operators import alias, blocking, decide, evaluate, features, graph, labels, model
from tessera.plans import sql_parts as sql
from tessera.sources import adapter, io

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, statement: str | None = None, recursive: bool = False):
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if statement is not None:
            _SQL[name] = sql.query(statement).replace("WITH ", "WITH RECURSIVE ", 1) if recursive else sql.query(statement)
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- shared inputs -------------------------------------------------------------------------


def _entities(s, d):
    return adapter.records(s, d).where("src = 1").select(F.col("id").alias("q_id"), "country")


def _unlabelled(s, d):
    """Candidates with a deterministic stand-in for a model's probability."""
    return blocking.candidates(adapter.store(s, d)).withColumn("p", F.least(F.lit(0.999), "score"))


def _scored(s, d):
    return labels.with_key_labels(_unlabelled(s, d), adapter.truth_keys(s, d))


def _pairs(s, d, with_idf=False, labelled=True):
    return features.joined_pairs(_scored(s, d) if labelled else _unlabelled(s, d), adapter.store(s, d), with_idf)


def _sizes(s, d):
    return labels.key_sizes(_entities(s, d), adapter.truth_keys(s, d))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_channel(spark, sf_dir)


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as strings, which both engines compare alike."""
    return df.select(*[F.array_join(c, " ").alias(c) if c in arrays else F.col(c) for c in df.columns])


# --- text ----------------------------------------------------------------------------------


@register("fold_ascii", f"SELECT id, {sql.fold('business_name')} AS folded FROM recs")
def fold_ascii(s, d):
    return adapter.records(s, d).select("id", text.fold(F.col("business_name")).alias("folded"))


@register("fold_text", f"SELECT doc_id, sha256({sql.fold('text')}) AS folded_sha256 FROM documents")
def fold_text(s, d):
    """The fold of whole document texts."""
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2(text.fold(F.col("text")), 256).alias("folded_sha256"))


@register("strip_junk", f"SELECT id, {sql.strip_junk('f')} AS stripped FROM (SELECT id, {sql.fold('''('#' || chr(45) || ' The ' || business_name || ' ..')''')} AS f FROM recs)")
def strip_junk(s, d):
    framed = F.concat(F.lit("#- The "), F.col("business_name"), F.lit(" .."))
    return adapter.records(s, d).select("id", text.strip_junk(text.fold(framed)).alias("stripped"))


@register("consonant_skeleton", f"SELECT p_partkey, {sql.skeleton('p_name')} AS skeleton FROM part")
def consonant_skeleton(s, d):
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", text.consonant_skeleton(F.col("p_name")).alias("skeleton"))


@register("vowel_squeeze", f"SELECT p_partkey, {sql.skeleton('p_name', vowels=True)} AS squeezed FROM part")
def vowel_squeeze(s, d):
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", text.vowel_squeeze(F.col("p_name")).alias("squeezed"))


_FORMS = ["Ltd", "private", "Inc.", "Kompany", "Tourist", "S.A.S", "limitteda", ""]
_FORM_SQL = "[" + ", ".join(sql.text(x) for x in _FORMS) + "][1 + c_custkey % 8]"
_COMPANY_SQL = f"SELECT c_custkey AS id, {sql.fold(f'''(c_name || ' ' || {_FORM_SQL})''')} AS f FROM customer"


def _companies(s, d):
    """Customer names with a legal form each."""
    form = F.get(F.array(*map(F.lit, _FORMS)), (F.col("c_custkey") % 8).cast("int"))
    return s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" "), form).alias("business_name"))


@register(
    "legal_split",
    f"""
SELECT id, array_to_string(CASE WHEN len(core) = 0 THEN w ELSE core END, ' ') AS core,
       array_to_string(list_sort(list_distinct(list_transform(list_filter(lc, lambda l: l IS NOT NULL), lambda l: coalesce({sql.mapping(text.tables.LEGAL_EQUAL)}[l], l)))), ',') AS legal
FROM (SELECT id, w, lc, list_filter(w, lambda t, i: lc[i] IS NULL) AS core FROM (
  SELECT id, w, list_transform(w, lambda t: {sql.legal_code('t')}) AS lc FROM (
    SELECT id, {sql.words(sql.strip_junk('f'))} AS w FROM ({_COMPANY_SQL}))))""",
)
def legal_split(s, d):
    parts = text.with_name_parts(_companies(s, d))
    return parts.select("id", F.array_join("core", " ").alias("core"), F.array_join("legal", ",").alias("legal"))


_TRADE_SQL = f"SELECT c_custkey AS id, {sql.fold('''(c_mktsegment || ' Group ' || ['dba', 'D/B/A', 'trading as', 't/a', 'and'][1 + c_custkey % 5] || ' ' || c_name)''')} AS f FROM customer"


@register("dba_split", f"SELECT id, {sql.trade_name('f')} AS trade FROM ({_TRADE_SQL})")
def dba_split(s, d):
    word = F.get(F.array(*map(F.lit, ["dba", "D/B/A", "trading as", "t/a", "and"])), (F.col("c_custkey") % 5).cast("int"))
    named = F.concat("c_mktsegment", F.lit(" Group "), word, F.lit(" "), F.col("c_name"))
    return s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), text.trade_name(text.fold(named)).alias("trade"))


_HOST_SQL = "regexp_extract(lower(coalesce(url, '')), '^(https?://[^/]*)', 1)"


@register("domain_stem", f"SELECT page_id, coalesce({sql.domain_stem(_HOST_SQL)}, '') AS stem FROM pages")
def domain_stem(s, d):
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), "^(https?://[^/]*)", 1)
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", F.coalesce(text.domain_stem(host), F.lit("")).alias("stem"))


@register("canon_addr", f"SELECT id, array_to_string(list_transform({sql.words(sql.fold('business_address'))}, lambda t: {sql.canon_word('t')}), ' ') AS canon FROM recs")
def canon_addr(s, d):
    words = text.words(text.fold(F.col("business_address")))
    return adapter.records(s, d).select("id", F.array_join(F.transform(words, text.canon_address_word), " ").alias("canon"))


_ADDRESS_SQL = "s_suppkey || ' Fourteenth Saint, Block ' || (s_suppkey % 40) || ', ' || (100000 + s_suppkey * 37 % 900000) // 1000 || ' ' || lpad(CAST((100000 + s_suppkey * 37 % 900000) % 1000 AS VARCHAR), 3, '0')"


def _supplier_addresses(s, d):
    code = F.expr("100000 + s_suppkey * 37 % 900000")
    address = F.concat(F.col("s_suppkey").cast("string"), F.lit(" Fourteenth Saint, Block "), (F.col("s_suppkey") % 40).cast("string"), F.lit(", "), F.expr("(100000 + s_suppkey * 37 % 900000) div 1000").cast("string"), F.lit(" "), F.lpad((code % 1000).cast("string"), 3, "0"))
    return s.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", address.alias("business_address"))


@register("postal_extract", f"SELECT s_suppkey, {sql.postal(sql.fold(f'({_ADDRESS_SQL})'))} AS postal FROM supplier")
def postal_extract(s, d):
    return _supplier_addresses(s, d).select("s_suppkey", text.postal_code(text.fold(F.col("business_address"))).alias("postal"))


@register("house_extract", "SELECT id, house FROM addresses")
def house_extract(s, d):
    return adapter.store(s, d).select("id", "house")


@register("addr_bag", "SELECT id, array_to_string(addr_tokens, ' ') AS addr_tokens, array_to_string(addr_digits, ' ') AS addr_digits, array_to_string(addr_alpha, ' ') AS addr_alpha, addr_skel, addr_empty FROM addresses")
def addr_bag(s, d):
    return _joined(adapter.store(s, d).select("id", "addr_tokens", "addr_digits", "addr_alpha", "addr_skel", "addr_empty"), "addr_tokens", "addr_digits", "addr_alpha")


@register("name_parts", "SELECT id, array_to_string(core, ' ') AS core, array_to_string(legal, ' ') AS legal, name_skel, name_squeeze, name_nospace, is_domain, had_dba FROM names")
def name_parts(s, d):
    return _joined(adapter.store(s, d).select("id", "core", "legal", "name_skel", "name_squeeze", "name_nospace", "is_domain", "had_dba"), "core", "legal")


@register("nospace_core", "SELECT id, name_nospace FROM names")
def nospace_core(s, d):
    return adapter.store(s, d).select("id", "name_nospace")


@register("acronym", "SELECT id, array_to_string(list_transform(core, lambda t: left(t, 1)), '') AS acronym FROM names")
def acronym(s, d):
    return adapter.store(s, d).select("id", text.acronym(F.col("core")).alias("acronym"))


@register("shingles", f"SELECT id, array_to_string({sql.shingles('name_skel')}, ' ') AS shingles FROM names")
def shingles(s, d):
    return adapter.store(s, d).select("id", F.array_join(text.shingles(F.col("name_skel")), " ").alias("shingles"))


@register("record_tokens", "SELECT id, ch, token, w FROM tokens")
def record_tokens(s, d):
    store = adapter.store(s, d)
    parts = [blocking.record_tokens(store, ch).select("id", F.lit(ch.name).alias("ch"), "token", "w") for ch in config.Blocking().channels]
    return parts[0].unionByName(parts[1])


@register(
    "store_rows",
    "SELECT num, src, country, array_to_string(core, ' ') AS name_core, name_skel, name_nospace, array_to_string(legal, ',') AS legal, array_to_string(addr_alpha, ' ') AS addr_alpha, array_to_string(addr_digits, ',') AS addr_digits, postal, house FROM store",
)
def store_rows(s, d):
    return io.store_rows(adapter.store(s, d))


# --- statistics ----------------------------------------------------------------------------


def _name_tokens(s, d):
    return blocking.record_tokens(adapter.store(s, d), config.NAME_CHANNEL)


@register("token_df", "SELECT country, token, df FROM df WHERE ch = 'name'")
def token_df(s, d):
    return blocking.token_df(_name_tokens(s, d))


@register("token_df_capped", "SELECT country, token, df FROM df WHERE ch = 'name' AND df BETWEEN 2 AND CASE left(token, 1) WHEN 'k' THEN 2500 WHEN 'w' THEN 400 WHEN 'S' THEN 400 ELSE 8000 END")
def token_df_capped(s, d):
    df = blocking.token_df(_name_tokens(s, d))
    return df.where((F.col("df") >= 2) & (F.col("df") <= blocking.cap_of(F.col("token"), config.NAME_CHANNEL)))


@register("idf", "SELECT country, token, df, round(idf, 6) AS idf FROM idf WHERE ch = 'name'")
def idf(s, d):
    store = adapter.store(s, d)
    weights = blocking.idf(blocking.token_df(_name_tokens(s, d)), blocking.country_sizes(store), config.NAME_CHANNEL)
    return weights.select("country", "token", "df", F.round("idf", 6).alias("idf"))


@register("tfidf_postings", "SELECT id, token, round(w, 6) AS w FROM postings WHERE ch = 'name'")
def tfidf_postings(s, d):
    return blocking.channel_postings(adapter.store(s, d), config.NAME_CHANNEL).select("id", "token", F.round("w", 6).alias("w"))


@register("token_freq", "SELECT token, count(*) AS freq FROM (SELECT unnest(core) AS token FROM names) GROUP BY token")
def token_freq(s, d):
    return alias.token_freq(adapter.store(s, d))


# --- blocking ------------------------------------------------------------------------------


def _channel(s, d, ch):
    return blocking.channel_candidates(adapter.store(s, d), ch)


@register("name_channel", "SELECT * FROM name_cands")
def name_channel(s, d):
    return _channel(s, d, config.NAME_CHANNEL)


@register("addr_channel", "SELECT * FROM addr_cands")
def addr_channel(s, d):
    return _channel(s, d, config.ADDRESS_CHANNEL)


@register("channel_union", "SELECT q_id, c_id, score, mask FROM cands")
def channel_union(s, d):
    return blocking.candidates(adapter.store(s, d)).select("q_id", "c_id", "score", "mask")


@register("cand_rank", "SELECT q_id, c_id, cand_rank, cand_count FROM cands")
def cand_rank(s, d):
    return blocking.candidates(adapter.store(s, d)).select("q_id", "c_id", "cand_rank", "cand_count")


@register(
    "blocking_recall",
    """
SELECT count(*) AS entities, CAST(sum(n_cand) AS BIGINT) AS pairs, round(sum(found) / sum(t_size), 6) AS micro_recall,
       round(avg(CASE WHEN t_size = 0 THEN 1.0e0 ELSE found / t_size END), 6) AS macro_recall,
       count(*) FILTER (t_size > 0 AND found = t_size) AS full_recall, count(*) FILTER (t_size > 0 AND found = 0) AS zero_recall
FROM (SELECT t_size, coalesce(found, 0) AS found, coalesce(n_cand, 0) AS n_cand FROM truth_sizes LEFT JOIN (SELECT q_id, sum(label) AS found, count(*) AS n_cand FROM scored GROUP BY q_id) USING (q_id))""",
)
def blocking_recall(s, d):
    return labels.blocking_recall(_scored(s, d), _sizes(s, d))


@register("channel_attribution", "SELECT mask, count(*) AS pairs, CAST(sum(label) AS BIGINT) AS true_pairs FROM scored GROUP BY mask")
def channel_attribution(s, d):
    return labels.channel_attribution(_scored(s, d))


@register(
    "candidate_stats",
    """
SELECT CAST(sum(n) AS BIGINT) AS pairs, count(*) AS entities, round(avg(n), 6) AS mean_candidates, max(n) AS most_candidates,
       round(1.0e0 - sum(n) / ((SELECT count(*) FROM recs WHERE src = 1) * (SELECT count(*) FROM recs WHERE src > 1)), 6) AS reduction
FROM (SELECT q_id, count(*) AS n FROM cands GROUP BY q_id)""",
)
def candidate_stats(s, d):
    sizes = adapter.records(s, d).agg(F.count_if(F.col("src") == 1).alias("n_q"), F.count_if(F.col("src") > 1).alias("n_c"))
    return labels.candidate_stats(blocking.candidates(adapter.store(s, d)), sizes)


_PRESET_SQL = " UNION ALL ".join(
    f"""
SELECT '{name}' AS preset, count(*) AS pairs, coalesce(CAST(sum(hit) AS BIGINT), 0) AS found, round(coalesce(sum(hit), 0) / (SELECT greatest(count(*), 1) FROM truth), 6) AS micro_recall
FROM (SELECT u.*, CAST(t.c_id IS NOT NULL AS INTEGER) AS hit FROM (
  SELECT q_id, c_id, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS rn FROM (
    SELECT q_id, c_id, max(score) AS score FROM (
      SELECT q_id, c_id, score FROM ranked WHERE ch = 'name' AND rn <= {p['name'][0]} AND score >= {p['name'][1]}e0
      UNION ALL SELECT q_id, c_id, score FROM ranked WHERE ch = 'addr' AND rn <= {p['addr'][0]} AND score >= {p['addr'][1]}e0) GROUP BY q_id, c_id)) u
  LEFT JOIN (SELECT DISTINCT q_id, c_id FROM truth) t USING (q_id, c_id) WHERE rn <= {p['cap']})"""
    for name, p in config.PRESETS.items()
)


@register(
    "blocking_sweep",
    f"""WITH raw AS (
  SELECT q.ch AS ch, q.id AS q_id, c.id AS c_id, round(sum(q.w * c.w), 6) AS score FROM postings q JOIN postings c ON q.country = c.country AND q.ch = c.ch AND q.token = c.token
  WHERE q.src = 1 AND c.src > 1 GROUP BY q.ch, q.id, c.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ch, q_id ORDER BY score DESC, c_id) AS rn FROM raw WHERE score >= CASE ch WHEN 'name' THEN 0.02e0 ELSE 0.04e0 END)
{_PRESET_SQL}""",
)
def blocking_sweep(s, d):
    return blocking.sweep(adapter.store(s, d), adapter.truth_keys(s, d))


# --- labels --------------------------------------------------------------------------------


@register("label_candidates", "SELECT q_id, c_id, label FROM scored")
def label_candidates(s, d):
    return _scored(s, d).select("q_id", "c_id", "label")


@register(
    "truth_structure",
    """
SELECT t_size, entities, round(sum(entities) OVER (ORDER BY t_size) / sum(entities) OVER (), 6) AS cumulative_share
FROM (SELECT t_size, count(*) AS entities FROM truth_sizes GROUP BY t_size)""",
)
def truth_structure(s, d):
    return labels.truth_structure(_sizes(s, d))


@register("disjointness", "SELECT count(*) AS linked, count(*) FILTER (n > 1) AS reused, max(n) AS max_reuse FROM (SELECT c_id, count(DISTINCT q_id) AS n FROM truth GROUP BY c_id)")
def disjointness(s, d):
    return labels.reuse(labels.linked(adapter.truth_keys(s, d), queries=False))


@register("semi_referenced", "SELECT id, country FROM recs WHERE src > 1 AND id IN (SELECT c_id FROM cands)")
def semi_referenced(s, d):
    store = adapter.store(s, d)
    return labels.referenced(store.where("src > 1"), blocking.candidates(store)).select("id", "country")


@register("anti_missing", "SELECT id AS q_id, country FROM recs WHERE src = 1 AND id NOT IN (SELECT q_id FROM cands)")
def anti_missing(s, d):
    return labels.missing_entities(_entities(s, d), blocking.candidates(adapter.store(s, d)))


# --- features ------------------------------------------------------------------------------


def _select(pairs: DataFrame, made: dict, *rounded: str) -> DataFrame:
    return pairs.select("q_id", "c_id", *[(F.round(v, 6) if k in rounded else v).alias(k) for k, v in made.items()])


def _bag_sql(prefix: str, a: str, b: str) -> str:
    both, either = f"len(list_intersect({a}, {b}))", f"len(list_distinct({a} || {b}))"
    least = f"least(len(list_distinct({a})), len(list_distinct({b})))"
    return f"round(CASE WHEN {either} = 0 THEN 0.0e0 ELSE {both} / {either} END, 6) AS {prefix}_jaccard, round({both} / CASE WHEN {least} = 0 THEN 1 ELSE {least} END, 6) AS {prefix}_containment, CAST({both} AS INTEGER) AS {prefix}_n_shared"


@register("feat_name_bag", f"SELECT q_id, c_id, {_bag_sql('name', 'qn', 'cn')}, CAST(len(list_distinct(qn)) AS INTEGER) AS name_tok_count_q, CAST(len(list_distinct(cn)) AS INTEGER) AS name_tok_count_c, CAST(abs(len(list_distinct(qn)) - len(list_distinct(cn))) AS INTEGER) AS name_tok_count_diff FROM pairs")
def feat_name_bag(s, d):
    return _select(_pairs(s, d, labelled=False), features.name_bag(), "name_jaccard", "name_containment")


@register("feat_addr_bag", f"SELECT q_id, c_id, {_bag_sql('addr', 'qa', 'ca')} FROM pairs")
def feat_addr_bag(s, d):
    return _select(_pairs(s, d, labelled=False), features.address_bag(), "addr_jaccard", "addr_containment")


@register("feat_digits", f"SELECT q_id, c_id, {_bag_sql('digit', 'qd', 'cd')} FROM pairs")
def feat_digits(s, d):
    return _select(_pairs(s, d, labelled=False), features.digits(), "digit_jaccard", "digit_containment")


_IDF_NAMES = ("name_idf_cosine", "name_idf_containment", "name_shared_max_idf", "name_shared_sum_idf", "name_unshared_max_idf_q", "name_unshared_max_idf_c", "addr_idf_cosine", "addr_shared_max_idf")


def _idf_sql() -> str:
    def weigh(kind: str, tokens: str) -> str:
        return f"SELECT country, token, ln((n + 1.0e0) / (df + 1.0e0)) + 1.0e0 AS w FROM (SELECT country, token, count(DISTINCT id) AS df FROM (SELECT id, country, unnest({tokens}) AS token FROM store) GROUP BY country, token) JOIN docs_in USING (country)"

    def sides(kind: str, q: str, c: str) -> str:
        return f"""{kind}_t AS (SELECT q_id, c_id, country, token, bool_or(side = 'q') AS in_q, bool_or(side = 'c') AS in_c FROM (
  SELECT q_id, c_id, country, unnest({q}) AS token, 'q' AS side FROM pairs UNION ALL SELECT q_id, c_id, country, unnest({c}), 'c' FROM pairs) GROUP BY q_id, c_id, country, token),
{kind}_s AS (SELECT q_id, c_id, sum(w * w) FILTER (in_q AND in_c) AS both2, sum(w) FILTER (in_q AND in_c) AS both1, max(w) FILTER (in_q AND in_c) AS best,
  sum(w * w) FILTER (in_q) AS q2, sum(w * w) FILTER (in_c) AS c2, sum(w) FILTER (in_q) AS q1, sum(w) FILTER (in_c) AS c1, max(w) FILTER (in_q AND NOT in_c) AS only_q, max(w) FILTER (in_c AND NOT in_q) AS only_c
  FROM {kind}_t JOIN {kind}_w USING (country, token) GROUP BY q_id, c_id)"""

    def ratio(x: str, y: str) -> str:
        return f"CASE WHEN coalesce({y}, 0) = 0 THEN 0.0e0 ELSE coalesce({x}, 0) / {y} END"

    return f"""WITH name_w AS ({weigh('name', 'core')}), addr_w AS ({weigh('addr', 'addr_alpha')}),
{sides('name', 'qn', 'cn')}, {sides('addr', 'qa', 'ca')}
SELECT p.q_id, p.c_id, round({ratio('n.both2', '(sqrt(n.q2) * sqrt(n.c2))')}, 6) AS name_idf_cosine, round({ratio('n.both1', 'least(n.q1, n.c1)')}, 6) AS name_idf_containment,
  round(coalesce(n.best, 0.0e0), 6) AS name_shared_max_idf, round(coalesce(n.both1, 0.0e0), 6) AS name_shared_sum_idf, round(coalesce(n.only_q, 0.0e0), 6) AS name_unshared_max_idf_q, round(coalesce(n.only_c, 0.0e0), 6) AS name_unshared_max_idf_c,
  round({ratio('a.both2', '(sqrt(a.q2) * sqrt(a.c2))')}, 6) AS addr_idf_cosine, round(coalesce(a.best, 0.0e0), 6) AS addr_shared_max_idf
FROM pairs p LEFT JOIN name_s n USING (q_id, c_id) LEFT JOIN addr_s a USING (q_id, c_id)"""


@register("feat_idf", _idf_sql())
def feat_idf(s, d):
    return _select(_pairs(s, d, with_idf=True, labelled=False), features.idf_features(), *_IDF_NAMES)


def _flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, FALSE) AS INTEGER)"


_QA, _CA = "array_to_string(list_transform(qn, lambda t: left(t, 1)), '')", "array_to_string(list_transform(cn, lambda t: left(t, 1)), '')"


@register(
    "feat_struct",
    f"""
SELECT q_id, c_id, {_flag("qk <> '' AND qk = ck")} AS skel_equal, {_flag("qk <> '' AND ck <> '' AND left(qk, least(6, length(qk), length(ck))) = left(ck, least(6, length(qk), length(ck)))")} AS skel_prefix_eq,
  {_flag("qw <> '' AND qw = cw")} AS nospace_equal, {_flag("qw <> '' AND cw <> '' AND (contains(qw, cw) OR contains(cw, qw))")} AS nospace_containment,
  {_flag(f"len(qn) > 0 AND len(cn) > 0 AND ({_QA} = cw OR {_CA} = qw OR {_QA} = {_CA})")} AS acronym_match,
  {_flag("list_has_any(ql, cl)")} AS legal_agree, {_flag("len(ql) > 0 AND len(cl) > 0 AND NOT list_has_any(ql, cl)")} AS legal_conflict, {_flag("len(ql) = 0 AND len(cl) = 0")} AS legal_both_empty,
  {_flag("qh <> '' AND qh = ch")} AS house_equal, {_flag("qh <> '' AND ch <> '' AND left(qh, 2) = left(ch, 2)")} AS house_prefix_eq,
  {_flag("qp <> '' AND qp = cp")} AS postal_equal, {_flag("qp <> '' AND cp <> '' AND left(qp, 3) = left(cp, 3)")} AS postal_prefix3, {_flag("qp <> '' AND cp <> ''")} AS both_have_postal
FROM pairs""",
)
def feat_struct(s, d):
    return _select(_pairs(s, d, labelled=False), features.structural())


@register("feat_missing", f"SELECT q_id, c_id, {_flag('len(qa) = 0')} AS addr_empty_q, {_flag('len(ca) = 0')} AS addr_empty_c, {_flag('len(qa) = 0 OR len(ca) = 0')} AS addr_empty_any FROM pairs")
def feat_missing(s, d):
    return _select(_pairs(s, d, labelled=False), features.missing())


@register(
    "feat_cross",
    """
SELECT q_id, c_id, round(CASE WHEN len(qn) = 0 THEN 0.0e0 ELSE len(list_intersect(qn, ca)) / len(list_distinct(qn)) END, 6) AS cross_name_in_addr,
  round(CASE WHEN len(cn) = 0 THEN 0.0e0 ELSE len(list_intersect(qa, cn)) / len(list_distinct(cn)) END, 6) AS cross_addr_in_name FROM pairs""",
)
def feat_cross(s, d):
    return _select(_pairs(s, d, labelled=False), features.cross(), "cross_name_in_addr", "cross_addr_in_name")


@register("feat_levenshtein", "SELECT q_id, c_id, CAST(levenshtein(qk, ck) AS INTEGER) AS skel_distance FROM pairs")
def feat_levenshtein(s, d):
    return _pairs(s, d, labelled=False).select("q_id", "c_id", F.levenshtein("qk", "ck").alias("skel_distance"))


@register("feat_jaro", "SELECT q_id, c_id, round(CASE WHEN qw = '' OR cw = '' THEN 0.0e0 ELSE jaro_winkler_similarity(qw, cw) END, 6) AS nospace_jaro FROM pairs")
def feat_jaro(s, d):
    @F.pandas_udf("double")
    def jaro(a, b):
        return a.combine(b, fuzzy.jaro_winkler).astype("float64")

    return _pairs(s, d, labelled=False).select("q_id", "c_id", F.round(jaro("qw", "cw"), 6).alias("nospace_jaro"))


@register("feat_fuzzy")
def feat_fuzzy(s, d):
    """All eleven fuzzy features, from one crossing to Python."""
    return features.with_fuzzy(_pairs(s, d, labelled=False)).select("q_id", "c_id", *[F.round(c, 6).alias(c) for c in features._FUZZY])


@register("design_matrix")
def design_matrix(s, d):
    store = adapter.store(s, d)
    matrix = features.design_matrix(labels.with_key_labels(blocking.candidates(store), adapter.truth_keys(s, d)), store)
    return matrix.select("q_id", "c_id", *[F.round(f, 6).alias(f) for f in features.FEATURES])


# --- graph ---------------------------------------------------------------------------------


@register(
    "group_stats",
    """
SELECT q_id, c_id, count(*) OVER w AS n, CAST(row_number() OVER (PARTITION BY c_id ORDER BY p DESC, q_id) - 1 AS INTEGER) AS rank, max(p) OVER w AS best,
       nth_value(p, 2) OVER (PARTITION BY c_id ORDER BY p DESC, q_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second
FROM scored WINDOW w AS (PARTITION BY c_id)""",
)
def group_stats(s, d):
    return graph.group_stats(_unlabelled(s, d).select("q_id", "c_id", "p"), "c_id", "p", "q_id").select("q_id", "c_id", "n", "rank", "best", "second")


_COMPETE_SQL = """WITH l AS (SELECT q_id, c_id, p, ln(greatest(1e-6, least(1 - 1e-6, p)) / (1 - greatest(1e-6, least(1 - 1e-6, p)))) AS lg FROM scored),
b AS (SELECT *, count(*) OVER (PARTITION BY c_id) AS n, row_number() OVER (PARTITION BY c_id ORDER BY lg DESC, q_id) - 1 AS rk, max(lg) OVER (PARTITION BY c_id) AS best,
  max(lg) OVER (PARTITION BY c_id ORDER BY lg DESC, q_id ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS following FROM l),
z AS (SELECT *, exp(greatest(-60.0e0, least(0.0e0, (lg - best) / 0.6e0))) AS z FROM b)"""


@register(
    "competition",
    f"""{_COMPETE_SQL}
SELECT q_id, c_id, round(lg, 6) AS p1_logit, n AS compete_count, CAST(rk AS INTEGER) AS compete_rank, CAST(rk = 0 AS INTEGER) AS compete_is_best,
  round(CASE WHEN n = 1 THEN 30.0e0 WHEN rk = 0 THEN lg - greatest(following, -30.0e0) ELSE lg - best END, 6) AS compete_margin,
  round(greatest(-10.0e0, least(10.0e0, CASE WHEN best = 0 THEN 1.0e0 ELSE lg / best END)), 6) AS compete_ratio FROM z""",
)
def competition(s, d):
    rows = graph.competition(_unlabelled(s, d))
    return rows.select("q_id", "c_id", F.round("p1_logit", 6).alias("p1_logit"), "compete_count", "compete_rank", "compete_is_best", F.round("compete_margin", 6).alias("compete_margin"), F.round("compete_ratio", 6).alias("compete_ratio"))


@register("compete_softmax", f"{_COMPETE_SQL} SELECT q_id, c_id, round(z / (sum(z) OVER (PARTITION BY c_id) + exp(greatest(-60.0e0, least(30.0e0, (0 - best) / 0.6e0)))), 6) AS compete_softmax FROM z")
def compete_softmax(s, d):
    return graph.competition(_unlabelled(s, d)).select("q_id", "c_id", F.round("compete_softmax", 6).alias("compete_softmax"))


@register(
    "entity_profile",
    """
SELECT q_id, c_id, count(*) OVER q AS entity_cand_count, CAST(row_number() OVER (PARTITION BY q_id ORDER BY p DESC, c_id) - 1 AS INTEGER) AS entity_p_rank, max(p) OVER q AS entity_p_max,
  round(sum(p) OVER q, 6) AS entity_p_sum, round(p - max(p) OVER q, 6) AS entity_p_margin_to_max, round(sum(p) OVER q / count(*) OVER q, 6) AS entity_p_mean,
  CAST(row_number() OVER (PARTITION BY q_id, src ORDER BY p DESC, c_id) - 1 AS INTEGER) AS entity_rank_in_source, max(p) OVER (PARTITION BY q_id, src) AS entity_source_p_max
FROM pairs WINDOW q AS (PARTITION BY q_id)""",
)
def entity_profile(s, d):
    rows = graph.entity_profile(_pairs(s, d, labelled=False))
    return rows.select(*[F.round(c, 6).alias(c) if c in ("entity_p_sum", "entity_p_margin_to_max", "entity_p_mean") else F.col(c) for c in rows.columns])


@register(
    "other_source",
    """
SELECT a.q_id, a.c_id, coalesce(max(b.p), 0.0e0) AS other_source_best_p, count(b.c_id) AS other_source_count
FROM pairs a LEFT JOIN pairs b ON a.q_id = b.q_id AND a.src <> b.src GROUP BY a.q_id, a.c_id""",
)
def other_source(s, d):
    return graph.other_source(_pairs(s, d, labelled=False))


_CORR = {"postal": ("cp", "cp"), "digit": ("cd", "array_to_string(cd, ',')"), "skel": ("ck", "ck")}


@register(
    "corroboration",
    "SELECT q_id, c_id, "
    + ", ".join(
        f"CAST(CASE WHEN {key} <> '' THEN count(*) OVER w_{name} - 1 ELSE 0 END AS BIGINT) AS corr_{name}_count, CASE WHEN {key} <> '' THEN coalesce(max(p) OVER (PARTITION BY q_id, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW), 0.0e0) ELSE 0.0e0 END AS corr_{name}_best_other_p"
        for name, (_, key) in _CORR.items()
    )
    + " FROM pairs WINDOW "
    + ", ".join(f"w_{name} AS (PARTITION BY q_id, {key})" for name, (_, key) in _CORR.items()),
)
def corroboration(s, d):
    rows = _pairs(s, d, labelled=False).withColumn("digit_key", F.array_join("cd", ","))
    return graph.corroboration(rows, {"postal": "cp", "digit": "digit_key", "skel": "ck"})


# --- decision ------------------------------------------------------------------------------

_LISTS_SQL = "ranked AS (SELECT q_id, c_id, p, label, row_number() OVER (PARTITION BY q_id ORDER BY p DESC, c_id) AS rn FROM scored), lists AS (SELECT q_id, list(p ORDER BY rn) AS ps FROM ranked WHERE p >= 0.01e0 GROUP BY q_id)"
_PMF_SQL = "list_reduce({ps}, lambda acc, pr: list_transform(range(1, len(acc) + 2), lambda i: coalesce(acc[i], 0.0e0) * (1.0e0 - pr[1]) + CASE WHEN i > 1 THEN acc[i - 1] ELSE 0.0e0 END * pr[1]), [1.0e0])"


@register("poisson_binomial", f"WITH {_LISTS_SQL}, top AS (SELECT q_id, list_transform(ps, lambda x: [x]) AS ps FROM lists) SELECT q_id, array_to_string(list_transform({_PMF_SQL.format(ps='ps')}, lambda x: CAST(CAST(round(x * 1e6) AS BIGINT) AS VARCHAR)), ' ') AS pmf FROM top")
def poisson_binomial(s, d):
    lists = decide.ranked(_unlabelled(s, d).where("p >= 0.01")).select("q_id", F.transform("items", lambda x: -x["np"]).alias("ps"))
    return lists.select("q_id", F.array_join(F.transform(decide.pmf(F.col("ps")), lambda x: F.round(x * 1e6).cast("bigint").cast("string")), " ").alias("pmf"))


_EV_SQL = f"""WITH {_LISTS_SQL},
ks AS (SELECT q_id, ps, unnest(range(0, least(len(ps), 25) + 1)) AS k FROM lists),
dist AS (SELECT q_id, k, {_PMF_SQL.format(ps='list_transform(ps[1:k], lambda x: [x])')} AS head, {_PMF_SQL.format(ps='list_transform(ps[k + 1:], lambda x: [x])')} AS tail FROM ks),
mass AS (SELECT q_id, least(1.0e0, coalesce(sum(p) FILTER (p < 0.01e0), 0.0e0)) AS mm FROM scored GROUP BY q_id),
tails AS (SELECT q_id, k, head, list_transform(range(1, len(tail) + 2), lambda i: coalesce(tail[i], 0.0e0) * (1 - mm) + CASE WHEN i > 1 THEN tail[i - 1] ELSE 0.0e0 END * mm) AS tail FROM dist JOIN mass USING (q_id)),
cells AS (SELECT q_id, k, head, tail, t, unnest(range(0, len(tail))) AS f FROM (SELECT *, unnest(range(0, len(head))) AS t FROM tails)),
ev AS (SELECT q_id, k, sum(head[t + 1] * tail[f + 1] * CASE WHEN k = 0 AND f = 0 THEN 1.0e0 WHEN t = 0 THEN 0.0e0 ELSE 1.25e0 * t / (0.25e0 * (t + f) + k) END) AS ev FROM cells GROUP BY q_id, k)"""


@register("expected_f_curve", f"{_EV_SQL} SELECT q_id, CAST(k AS INTEGER) AS k, round(ev, 6) AS expected_f FROM ev")
def expected_f_curve(s, d):
    """Expected F of every prefix, with what is below the pruning bound as missing mass."""

    @F.pandas_udf("array<double>")
    def curves(lists, masses):
        import numpy as np
        import pandas as pd

        return pd.Series([decide.expected_f(np.asarray(x, float), config.Decision(missing_mass=m))[:26].tolist() for x, m in zip(lists, masses, strict=True)])

    lists = decide.ranked(_unlabelled(s, d)).select("q_id", F.transform("items", lambda x: -x["np"]).alias("all"))
    low = F.aggregate(F.filter("all", lambda p: p < 0.01), F.lit(0.0), lambda a, p: a + p)
    kept = lists.select("q_id", F.filter("all", lambda p: p >= 0.01).alias("ps"), low.alias("mass")).where(F.size("ps") > 0)
    return kept.select("q_id", F.posexplode(curves("ps", "mass")).alias("k", "expected_f")).select("q_id", "k", F.round("expected_f", 6).alias("expected_f"))


@register(
    "decide_expected_f",
    f"{_EV_SQL}, best AS (SELECT q_id, arg_min(k, (-round(ev, 9), k)) AS k, arg_min(ev, (-round(ev, 9), k)) AS ev FROM ev GROUP BY q_id) SELECT q_id, CAST(k AS INTEGER) AS k, round(ev, 6) AS expected_f FROM best",
)
def decide_expected_f(s, d):
    """The exact rule looks at every candidate that blocking gives."""
    whole = config.Decision(longest=config.Blocking().max_candidates)
    return decide.decide(_unlabelled(s, d), whole).select("q_id", "k", F.round("expected_f", 6).alias("expected_f"))


@register("decide_threshold", "SELECT q_id, least(count(*) FILTER (p >= 0.5e0), 25) AS k FROM scored GROUP BY q_id")
def decide_threshold(s, d):
    return decide.decide_threshold(_unlabelled(s, d), 0.5)


@register("decide_top1", "SELECT q_id, CAST(max(p) >= 0.5e0 AS INTEGER) AS k FROM scored GROUP BY q_id")
def decide_top1(s, d):
    return decide.decide(_unlabelled(s, d), config.Decision(rule="top1")).select("q_id", "k")


@register("decide_topk", "SELECT q_id, c_id FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY p DESC, c_id) AS rn FROM scored) WHERE rn <= 3")
def decide_topk(s, d):
    return decide.decide(_unlabelled(s, d), config.Decision(rule="topk")).select("q_id", F.explode("selected").alias("c_id"))


_PICKED_SQL = "picked AS (SELECT q_id, c_id, p, label FROM scored WHERE p >= 0.5e0), kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_id ORDER BY p DESC, q_id) AS rn FROM picked) WHERE rn = 1)"


def _picked(s, d):
    return graph.disjoint_repair(_scored(s, d).where("p >= 0.5").select("q_id", "c_id", "p", "label"))


@register("disjoint_repair", f"WITH {_PICKED_SQL} SELECT q_id, c_id, p FROM kept")
def disjoint_repair(s, d):
    return _picked(s, d).select("q_id", "c_id", "p")


@register("entity_psum", "SELECT q_id, count(*) AS n_cand, round(sum(p), 6) AS p_sum FROM scored GROUP BY q_id")
def entity_psum(s, d):
    return _unlabelled(s, d).groupBy("q_id").agg(F.count(F.lit(1)).alias("n_cand"), F.round(F.sum("p"), 6).alias("p_sum"))


@register("missing_mass_heuristic", "SELECT q_id, round(least(greatest(CASE WHEN n = 0 THEN greatest(p_sum * ((1 - 0.88e0) / 0.88e0), (1 - 0.88e0) / 0.88e0) ELSE p_sum * ((1 - 0.88e0) / 0.88e0) END, 0.0e0), 8.0e0), 6) AS missing_mass FROM (SELECT r.id AS q_id, count(c_id) AS n, round(coalesce(sum(p), 0.0e0), 6) AS p_sum FROM recs r LEFT JOIN scored s ON r.id = s.q_id WHERE r.src = 1 GROUP BY r.id)")
def missing_mass_heuristic(s, d):
    per = _entities(s, d).join(entity_psum(s, d), "q_id", "left").select("q_id", F.coalesce("n_cand", F.lit(0)).alias("n_cand"), F.coalesce("p_sum", F.lit(0.0)).alias("p_sum"))
    return decide.missing_mass_heuristic(per, 0.88).select("q_id", F.round("missing_mass", 6).alias("missing_mass"))


_GRID = [(t, k) for t in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8) for k in (1, 2, 3, 25)]


@register(
    "decision_grid",
    f"""WITH grid AS (SELECT * FROM (VALUES {', '.join(f'({t}e0, {k})' for t, k in _GRID)}) g(threshold, most)),
ranked AS (SELECT q_id, c_id, p, label, row_number() OVER (PARTITION BY q_id ORDER BY p DESC, c_id) AS rn FROM scored),
per AS (SELECT threshold, most, q_id, count(*) AS k, sum(label) AS tp FROM ranked, grid WHERE p >= threshold AND rn <= most GROUP BY ALL),
f AS (SELECT g.threshold, g.most, t.q_id, t_size, coalesce(k, 0) AS k, coalesce(tp, 0) AS tp FROM grid g CROSS JOIN truth_sizes t LEFT JOIN per p ON p.threshold = g.threshold AND p.most = g.most AND p.q_id = t.q_id)
SELECT threshold, most, round(avg(CASE WHEN k = 0 AND t_size = 0 THEN 1.0e0 WHEN tp = 0 THEN 0.0e0 ELSE 1.25e0 * tp / (0.25e0 * t_size + k) END), 6) AS macro_f05 FROM f GROUP BY threshold, most""",
)
def decision_grid(s, d):
    """Macro F of every threshold and cap of a grid, in one pass over the pairs."""
    rules = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(k).alias("most")) for t, k in _GRID])
    ranked = _scored(s, d).withColumn("rn", F.row_number().over(graph.Window.partitionBy("q_id").orderBy(F.col("p").desc(), "c_id")))
    each = ranked.select("q_id", "p", "label", "rn", F.explode(rules).alias("g")).where((F.col("p") >= F.col("g.threshold")) & (F.col("rn") <= F.col("g.most")))
    per = each.groupBy("q_id", "g.threshold", "g.most").agg(F.count(F.lit(1)).alias("k"), F.sum("label").alias("tp"))
    every = _sizes(s, d).select("q_id", "t_size", F.explode(rules).alias("g")).select("q_id", "t_size", "g.threshold", "g.most")
    joined = every.join(per, ["q_id", "threshold", "most"], "left").withColumn("k", F.coalesce("k", F.lit(0))).withColumn("tp", F.coalesce("tp", F.lit(0)))
    return joined.groupBy("threshold", "most").agg(F.round(F.avg(evaluate.f_beta(F.col("tp"), F.col("k"), F.col("t_size"))), 6).alias("macro_f05"))


# --- evaluation ----------------------------------------------------------------------------

_COUNTS_SQL = f"{_PICKED_SQL}, counts AS (SELECT q_id, country, t_size, coalesce(k, 0) AS k, coalesce(tp, 0) AS tp FROM truth_sizes LEFT JOIN (SELECT q_id, count(*) AS k, CAST(sum(label) AS BIGINT) AS tp FROM kept GROUP BY q_id) USING (q_id))"
_F05_SQL = f"""{_COUNTS_SQL}, f05 AS (SELECT *, CASE WHEN k = 0 AND t_size = 0 THEN 1.0e0 WHEN tp = 0 THEN 0.0e0 ELSE 1.25e0 * tp / (0.25e0 * t_size + k) END AS f05,
  CASE WHEN k = 0 THEN CAST(t_size = 0 AS DOUBLE) ELSE tp / k END AS precision, CASE WHEN t_size = 0 THEN CAST(k = 0 AS DOUBLE) ELSE tp / t_size END AS recall,
  CASE WHEN t_size = 0 AND k = 0 THEN 'singleton_ok' WHEN t_size = 0 THEN 'false_merge_on_singleton' WHEN tp = 0 AND k = 0 THEN 'missed_all' WHEN tp = 0 THEN 'false_merge_on_matched' WHEN tp = k AND tp = t_size THEN 'exact' ELSE 'partial' END AS verdict FROM counts)"""


def _per_entity(s, d):
    return evaluate.entity_f05(evaluate.entity_counts(_sizes(s, d), _picked(s, d)))


@register("entity_counts", f"WITH {_COUNTS_SQL} SELECT q_id, t_size, k, tp FROM counts")
def entity_counts(s, d):
    return evaluate.entity_counts(_sizes(s, d), _picked(s, d)).select("q_id", "t_size", "k", "tp")


@register("entity_f05", f"WITH {_F05_SQL} SELECT q_id, round(f05, 6) AS f05, round(precision, 6) AS precision, round(recall, 6) AS recall, verdict FROM f05")
def entity_f05(s, d):
    return _per_entity(s, d).select("q_id", *[F.round(c, 6).alias(c) for c in ("f05", "precision", "recall")], "verdict")


_MACRO_SQL = "count(*) AS entities, round(avg(f05), 6) AS macro_f05, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(k), 6) AS mean_k"


@register("macro_fbeta", f"WITH {_F05_SQL} SELECT {_MACRO_SQL} FROM f05")
def macro_fbeta(s, d):
    return evaluate.macro(_per_entity(s, d))


@register("by_country", f"WITH {_F05_SQL} SELECT country, {_MACRO_SQL} FROM f05 GROUP BY country")
def by_country(s, d):
    return evaluate.macro(_per_entity(s, d), "country")


@register("verdict_hist", f"WITH {_F05_SQL} SELECT verdict, count(*) AS entities FROM f05 GROUP BY verdict")
def verdict_hist(s, d):
    return evaluate.histogram(_per_entity(s, d), "verdict")


@register("k_hist", f"WITH {_F05_SQL} SELECT k, count(*) AS entities FROM f05 GROUP BY k")
def k_hist(s, d):
    return evaluate.histogram(_per_entity(s, d), "k")


@register("reliability", "SELECT CAST(least(floor(p * 15), 14) AS INTEGER) AS bin, country, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(label), 6) AS mean_y FROM pairs GROUP BY GROUPING SETS ((bin), (bin, country))")
def reliability(s, d):
    return evaluate.reliability(_pairs(s, d), by="country")


@register("ece_brier", "SELECT round(sum(n * abs(mp - my)) / sum(n), 6) AS ece, round(sum(se) / sum(n), 6) AS brier, CAST(sum(n) AS BIGINT) AS n FROM (SELECT least(floor(p * 15), 14) AS b, count(*) AS n, avg(p) AS mp, avg(label) AS my, sum((p - label) * (p - label)) AS se FROM scored GROUP BY b)")
def ece_brier(s, d):
    return evaluate.ece_brier(_scored(s, d))


@register(
    "roc_auc",
    """
SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0e0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS auc,
       count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg
FROM (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0e0 AS r FROM scored)""",
)
def roc_auc(s, d):
    return evaluate.roc_auc(_scored(s, d))


@register(
    "avg_precision",
    """
SELECT round(sum(pos * tp / k) / sum(pos), 6) AS ap, CAST(sum(pos) AS BIGINT) AS n_pos
FROM (SELECT pos, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS k FROM (SELECT p, count(*) AS n, sum(label) AS pos FROM scored GROUP BY p))""",
)
def avg_precision(s, d):
    return evaluate.average_precision(_scored(s, d))


_SEPARATED = ["score", "cand_rank", "cand_count", "mask"]


@register(
    "feature_separation",
    f"""WITH long AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, label, CAST({f} AS DOUBLE) AS x FROM scored" for f in _SEPARATED)}),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0e0 AS rk FROM long)
SELECT feature, round(avg(x) FILTER (label = 1), 6) AS pos_mean, round(avg(x) FILTER (label = 0), 6) AS neg_mean,
  round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0e0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS auc FROM r GROUP BY feature""",
)
def feature_separation(s, d):
    return evaluate.feature_separation(_scored(s, d), _SEPARATED)


@register("ev_calibration", f"WITH {_F05_SQL}, e AS (SELECT f05, round(least(1.0e0, k / 10.0e0), 6) AS x FROM f05) SELECT CAST(least(floor(x * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(x), 6) AS mean_expected, round(avg(f05), 6) AS mean_realised FROM e GROUP BY bin")
def ev_calibration(s, d):
    """Bins by a stand-in expectation that both engines compute alike."""
    per = _per_entity(s, d).withColumn("expected_f", F.round(F.least(F.lit(1.0), F.col("k") / 10.0), 6))
    return evaluate.ev_calibration(per)


@register("f05_ceiling_curve", "SELECT r AS recall, round(1.25e0 * r / (0.25e0 + r), 6) AS ceiling FROM (SELECT round(0.5e0 + i * 0.02e0, 2) AS r FROM range(26) t(i))")
def f05_ceiling_curve(s, d):
    return evaluate.f05_ceiling_curve(s)


_RULES = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


@register(
    "ablation",
    f"""WITH r AS (SELECT unnest([{', '.join(f'{t}e0' for t in _RULES)}]) AS t),
per AS (SELECT t, q_id, count(*) AS k, sum(label) AS tp FROM scored, r WHERE p >= t GROUP BY t, q_id),
m AS (SELECT 'threshold_' || CAST(t AS VARCHAR) AS rule, round(avg(CASE WHEN coalesce(k, 0) = 0 AND t_size = 0 THEN 1.0e0 WHEN coalesce(tp, 0) = 0 THEN 0.0e0 ELSE 1.25e0 * tp / (0.25e0 * t_size + k) END), 6) AS macro_f05
  FROM (SELECT r.t, x.q_id, t_size FROM r CROSS JOIN truth_sizes x) LEFT JOIN per USING (t, q_id) GROUP BY t)
SELECT rule, macro_f05, round(macro_f05 - (SELECT macro_f05 FROM m WHERE rule = 'threshold_0.5'), 6) AS delta FROM m""",
)
def ablation(s, d):
    grid = F.array(*map(F.lit, _RULES))
    per = _scored(s, d).select("q_id", "label", "p", F.explode(grid).alias("t")).where("p >= t").groupBy("t", "q_id").agg(F.count(F.lit(1)).alias("k"), F.sum("label").alias("tp"))
    every = _sizes(s, d).select("q_id", "t_size", F.explode(grid).alias("t")).join(per, ["t", "q_id"], "left")
    score = evaluate.f_beta(F.coalesce("tp", F.lit(0)), F.coalesce("k", F.lit(0)), F.col("t_size"))
    rules = every.groupBy("t").agg(F.round(F.avg(score), 6).alias("macro_f05")).select(F.concat(F.lit("threshold_"), F.col("t").cast("string")).alias("rule"), "macro_f05")
    return evaluate.ablation(rules, "threshold_0.5")


# --- mining --------------------------------------------------------------------------------

_DIFF_SQL = """diff AS (SELECT q_id, c_id, xs, ys FROM (SELECT t.q_id, t.c_id, list_filter(list_distinct(a.addr_alpha), lambda x: NOT list_contains(b.addr_alpha, x)) AS xs, list_filter(list_distinct(b.addr_alpha), lambda x: NOT list_contains(a.addr_alpha, x)) AS ys
  FROM (SELECT DISTINCT q_id, c_id FROM truth) t JOIN store a ON t.q_id = a.id JOIN store b ON t.c_id = b.id) WHERE len(xs) BETWEEN 1 AND 3 AND len(ys) BETWEEN 1 AND 3),
marg AS (SELECT token, count(*) AS n FROM (SELECT unnest(xs || ys) AS token FROM diff) GROUP BY token),
each AS (SELECT x, unnest(ys) AS y FROM (SELECT unnest(xs) AS x, ys FROM diff)),
sl AS (SELECT x, y, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS sh, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS lo FROM each),
ok AS (SELECT least(x, y) AS a, greatest(x, y) AS b FROM sl WHERE length(sh) >= 2 AND NOT regexp_full_match(x, '[0-9]+') AND NOT regexp_full_match(y, '[0-9]+')
  AND (list_reduce([1] || list_transform(string_split(sh, ''), lambda c: unicode(c) + 1000), lambda p, c: CASE WHEN p > 0 AND strpos(substr(lo, p), chr(CAST(c - 1000 AS INTEGER))) > 0 THEN p + strpos(substr(lo, p), chr(CAST(c - 1000 AS INTEGER))) ELSE 0 END) > 0
    OR (left(x, 1) = left(y, 1) AND length(sh) >= 3))),
joint AS (SELECT a, b, count(*) AS n FROM ok GROUP BY a, b),
strong AS (SELECT a, b, j.n, round(j.n / sqrt(x.n * y.n), 6) AS score FROM joint j JOIN marg x ON x.token = a JOIN marg y ON y.token = b)"""
#: Counts asked of the driver's small tables; the engine's default is 15.
_SMALL_MINING = config.Mining(min_count=2)


def _diff(s, d):
    return alias.unmatched(adapter.truth_links(s, d), adapter.store(s, d), "addr_alpha")


@register("alias_marginal", f"WITH {_DIFF_SQL} SELECT token, n FROM marg")
def alias_marginal(s, d):
    return alias.marginals(_diff(s, d))


@register("alias_joint", f"WITH {_DIFF_SQL} SELECT a, b, n FROM joint")
def alias_joint(s, d):
    return alias.joint(_diff(s, d))


@register("alias_pairs", f"WITH {_DIFF_SQL} SELECT a, b, n, score FROM strong WHERE n >= 2 AND score >= 0.12e0")
def alias_pairs(s, d):
    return alias.alias_pairs(_diff(s, d), _SMALL_MINING)


@register(
    "alias_map",
    f"""WITH {_DIFF_SQL},
links AS (SELECT a, b FROM strong WHERE n >= 2 AND score >= 0.12e0),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS token, a AS other FROM edges UNION SELECT r.token, e.b FROM reach r JOIN edges e ON r.other = e.a),
freqs AS (SELECT token, count(*) AS freq FROM (SELECT unnest(addr_alpha) AS token FROM store) GROUP BY token),
grouped AS (SELECT token, min(other) AS grp FROM reach GROUP BY token),
best AS (SELECT token, first_value(token) OVER (PARTITION BY grp ORDER BY coalesce(freq, 0) DESC, length(token), token DESC) AS canonical FROM grouped LEFT JOIN freqs USING (token))
SELECT token, canonical FROM best WHERE token <> canonical""",
    recursive=True,
)
def alias_map(s, d):
    if s.sparkContext.getCheckpointDir() is None:
        folder = s.conf.get("spark.checkpoint.dir", None)
        if not folder and s.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        s.sparkContext.setCheckpointDir(folder or "/tmp/checkpoints")
    store = adapter.store(s, d)
    return alias.alias_map(alias.alias_pairs(_diff(s, d), _SMALL_MINING), alias.token_freq(store, "addr_alpha"))


# --- sources, sinks, profiles --------------------------------------------------------------


@register("profile", "SELECT src, count(*) AS rows, count(*) FILTER (trim(business_name) = '') AS empty_name, count(*) FILTER (trim(business_address) = '') AS empty_address, count(DISTINCT country) AS countries FROM recs GROUP BY src")
def profile(s, d):
    return evaluate.profile(adapter.records(s, d))


@register("country_mix", "SELECT src, country, count(*) AS rows FROM recs GROUP BY src, country")
def country_mix(s, d):
    return evaluate.country_mix(adapter.records(s, d))


@register("submission_rows", f"WITH {_PICKED_SQL} SELECT r.id AS q_id, coalesce(array_to_string(list_sort(list_distinct(list(k.c_id) FILTER (k.c_id IS NOT NULL))), ','), '') AS matched FROM recs r LEFT JOIN kept k ON r.id = k.q_id WHERE r.src = 1 GROUP BY r.id")
def submission_rows(s, d):
    return io.submission_rows(_entities(s, d).select("q_id"), _picked(s, d))


def _lists(s, d):
    """The repaired decisions as lists, with some entities misspelt and some lists doubled, for the validator."""
    lists = io.submission_rows(_entities(s, d).select("q_id"), _picked(s, d)).withColumn("ids", F.filter(F.split("matched", ","), lambda x: x != ""))
    num = F.expr("CAST(substring(q_id, 4) AS bigint)")
    odd = F.when(num % 17 == 0, F.concat(F.lit("X"), F.col("q_id"))).otherwise(F.col("q_id"))
    return lists.select(odd.alias("q_id"), F.when(num % 5 == 0, F.concat("ids", "ids")).otherwise(F.col("ids")).alias("ids"))


@register(
    "validate_lists",
    f"""WITH {_PICKED_SQL},
s AS (SELECT r.id AS q_id, CAST(substring(r.id, 4) AS BIGINT) AS num, coalesce(list_sort(list_distinct(list(k.c_id) FILTER (k.c_id IS NOT NULL))), []) AS ids FROM recs r LEFT JOIN kept k ON r.id = k.q_id WHERE r.src = 1 GROUP BY r.id),
l AS (SELECT CASE WHEN num % 17 = 0 THEN 'X' || q_id ELSE q_id END AS q_id, CASE WHEN num % 5 = 0 THEN ids || ids ELSE ids END AS ids FROM s),
e AS (SELECT q_id, unnest(ids) AS c_id FROM l)
SELECT (SELECT count(*) FROM recs WHERE src = 1 AND id NOT IN (SELECT q_id FROM l)) AS missing_entities, (SELECT count(*) FROM (SELECT DISTINCT q_id FROM l) WHERE q_id NOT IN (SELECT id FROM recs WHERE src = 1)) AS unknown_entities,
  (SELECT count(*) FROM (SELECT q_id FROM l GROUP BY q_id HAVING count(*) > 1)) AS repeated_entities, (SELECT count(*) FROM l WHERE len(list_distinct(ids)) < len(ids)) AS lists_with_repeats, (SELECT count(*) FROM l WHERE len(ids) = 0) AS empty_lists,
  (SELECT count(*) FROM e WHERE q_id = c_id) AS self_matches, (SELECT count(*) FROM e WHERE NOT regexp_matches(c_id, '^S[23]-')) AS bad_prefixes, (SELECT count(*) FROM e WHERE c_id NOT IN (SELECT id FROM recs WHERE src > 1)) AS unknown_ids""",
)
def validate_lists(s, d):
    return io.validate_lists(_entities(s, d).select("q_id"), _lists(s, d), adapter.records(s, d).where("src > 1"))


@register(
    "submission_repair",
    """
SELECT q_id, array_to_string(list(c_id ORDER BY grp, ord, c_id), ',') AS ids FROM (
  SELECT q_id, c_id, 0 AS grp, cand_rank AS ord FROM cands WHERE cand_rank < 5
  UNION ALL SELECT q_id, c_id, 1, 0 FROM (SELECT s.q_id, s.c_id FROM scored s WHERE p >= 0.3e0 AND s.q_id IN (SELECT q_id FROM cands WHERE cand_rank < 5) AND NOT EXISTS (SELECT 1 FROM cands c WHERE c.cand_rank < 5 AND c.q_id = s.q_id AND c.c_id = s.c_id)))
GROUP BY q_id""",
)
def submission_repair(s, d):
    scored = _unlabelled(s, d)
    short = scored.where("cand_rank < 5").groupBy("q_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("cand_rank", "c_id"))), lambda x: x["c_id"]).alias("ids"))
    matches = scored.where("p >= 0.3").groupBy("q_id").agg(F.array_sort(F.collect_list("c_id")).alias("ids"))
    return io.repair_candidates(short, matches).select("q_id", F.array_join("ids", ",").alias("ids"))


@register("entity_page", f"WITH {_F05_SQL} SELECT q_id, country, round(f05, 6) AS f05, verdict FROM f05 WHERE verdict <> 'exact' ORDER BY f05, q_id LIMIT 50")
def entity_page(s, d):
    """The 50 worst entities: a page is what this query is for."""
    per = _per_entity(s, d).select("q_id", "country", "f05", "verdict").where("verdict <> 'exact'")
    return per.orderBy("f05", "q_id").limit(50).select("q_id", "country", F.round("f05", 6).alias("f05"), "verdict")


# --- learning ------------------------------------------------------------------------------


def _numbers(s, d):
    """Labelled pairs with native features that need no Python."""
    pairs = _pairs(s, d)
    made = features.name_bag() | features.address_bag() | features.digits() | features.structural()
    return model.split_by_entity(pairs.select("q_id", "c_id", "src", "country", "label", "score", "p", "cand_rank", "cand_count", "cp", "ck", F.array_join("cd", ",").alias("cdk"), *[v.cast("double").alias(k) for k, v in made.items()])), ["score", "cand_rank", "cand_count", *made]


@register("rank_norm", "SELECT q_id, c_id, round((rank() OVER (ORDER BY score) - 1 + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0) / (count(*) OVER () - 1), 6) AS rank_norm FROM scored")
def rank_norm(s, d):
    return model.rank_norm(_unlabelled(s, d), "score").select("q_id", "c_id", F.round("rank_norm", 6).alias("rank_norm"))


@register("gbt_stage1")
def gbt_stage1(s, d):
    pairs, names = _numbers(s, d)
    pairs = pairs.persist()
    return model.score(model.fit(pairs.where("NOT is_val"), names), pairs).select("q_id", "c_id", "label", "is_val", "p1")


@register("gbt_stage2")
def gbt_stage2(s, d):
    """Stage two on stage one's features with the graph columns of its probabilities."""
    pairs, names = _numbers(s, d)
    pairs = pairs.persist()
    first = model.score(model.fit(pairs.where("NOT is_val"), names), pairs).withColumn("p", F.col("p1")).drop("p1").persist()
    keys = {"postal": "cp", "digit": "cdk", "skel": "ck"}
    rows = first.join(graph.graph_features(first, keys), ["q_id", "c_id"]).persist()
    more = [c for c in rows.columns if c.startswith(("compete_", "entity_", "corr_", "other_source", "p1"))]
    return model.score(model.fit(rows.where("NOT is_val"), names + more), rows, "p2").select("q_id", "c_id", "label", "is_val", "p1", "p2")


@register("ensemble_scores")
def ensemble_scores(s, d):
    pairs, names = _numbers(s, d)
    pairs = pairs.persist()
    return model.ensemble(pairs.where("NOT is_val"), pairs, names).select("q_id", "c_id", "label", "is_val", "p1")


@register("isotonic_calibrate")
def isotonic_calibrate(s, d):
    pairs = model.split_by_entity(_pairs(s, d)).persist()
    return model.group_calibrate(pairs.where("NOT is_val"), pairs, least=500).select("q_id", "c_id", "label", "p", "p_cal")


@register("missing_mass_fitted")
def missing_mass_fitted(s, d):
    per = _scored(s, d).groupBy("q_id").agg(F.count(F.lit(1)).alias("n_cand"), F.sum("p").alias("p_sum"))
    every = _sizes(s, d).join(per, "q_id", "left").select("q_id", "t_size", F.coalesce("n_cand", F.lit(0)).alias("n_cand"), F.coalesce("p_sum", F.lit(0.0)).alias("p_sum")).persist()
    return model.missing_mass_fitted(every, every).select("q_id", "n_cand", "p_sum", "expected_truth", "missing_mass")
