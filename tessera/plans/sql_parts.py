"""DuckDB counterparts of the expressions and views, written for SQL and not generated from Spark plans."""

from __future__ import annotations

from tessera.functions import tables


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mapping(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{text(k)}: {text(v)}" for k, v in pairs.items()) + "}"


def fold(x: str) -> str:
    beyond = f"regexp_matches(coalesce({x}, ''), '[^\\x00-\\x7F]')"
    plain = f"regexp_replace(coalesce({x}, ''), '[\\x{{0300}}-\\x{{036F}}]', '', 'g')"
    for a, b in tables.DOUBLE_LETTERS:
        plain = f"replace({plain}, {text(a)}, {text(b)})"
    source, target = tables.latin_letters()
    plain = f"translate({plain}, {text(source)}, {text(target)})"
    for a, b in (("N", "n"), ("ph", "f"), ("PH", "F")):
        plain = f"replace({plain}, '{a}', '{b}')"
    chosen = f"CASE WHEN {beyond} THEN regexp_replace({plain}, '[^\\x00-\\x7F]', '', 'g') ELSE coalesce({x}, '') END"
    return f"trim(regexp_replace(lower({chosen}), '\\s+', ' ', 'g'))"


def strip_junk(x: str) -> str:
    edge = tables.EDGE_CLASS
    return f"trim(regexp_replace(regexp_replace({x}, {text(f'^{edge}|{edge}$')}, '', 'g'), {text(tables.LEADING_NOISE)}, ''))"


def _once(x: str) -> str:
    return f"array_to_string([c[2] FOR c IN list_zip([''] || string_split({x}, ''), string_split({x}, '')) IF c[2] IS NOT NULL AND c[1] <> c[2]], '')"


def skeleton(x: str, vowels: bool = False) -> str:
    drop = "[^0-9a-z]" if vowels else "[aeiou]|[^0-9a-z]"
    bare = f"regexp_replace(replace(lower({x}), 'ph', 'f'), '{drop}', '', 'g')"
    return _once(bare)


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[^a-z0-9]+'), lambda wd: wd <> '')"


def legal_code(x: str) -> str:
    key = skeleton(x)
    return f"coalesce({mapping(tables.legal_words())}[{x}], CASE WHEN length({x}) >= {tables.LEGAL_WORD_MIN} AND length({key}) >= {tables.LEGAL_SKELETON_MIN} THEN {mapping(tables.legal_skeletons())}[{key}] END)"


def trade_name(x: str) -> str:
    parts = f"regexp_split_to_array({x}, {text(tables.TRADE_NAME)})"
    longest = f"trim(list_reduce({parts}[2:], lambda p, r: CASE WHEN length(r) > length(p) THEN r ELSE p END))"
    return f"CASE WHEN len({parts}) > 1 THEN CASE WHEN {longest} <> '' THEN {longest} ELSE {parts}[1] END ELSE {x} END"


def domain_stem(x: str) -> str:
    return f"replace(nullif(regexp_extract(replace({x}, ' ', ''), {text(tables.DOMAIN)}, 1), ''), '-', ' ')"


def canon_word(x: str) -> str:
    ordinal = f"regexp_extract({x}, {text(tables.ORDINAL_DIGITS)}, 1)"
    return f"CASE WHEN {ordinal} <> '' THEN {ordinal} ELSE coalesce({mapping(tables.address_words())}[{x}], {x}) END"


def postal(x: str) -> str:
    runs = f"regexp_extract_all(regexp_replace({x}, {text(tables.SPLIT_POSTAL)}, '\\1\\2', 'g'), '[0-9]+')"
    return f"coalesce(list_filter({runs}, lambda r: length(r) = 6)[1], list_filter({runs}, lambda r: length(r) = 5)[1], '')"


def house(x: str) -> str:
    return f"coalesce(list_filter({words(f'string_split({x}, chr(44))[1]')}, lambda h: regexp_matches(h, '[0-9]'))[1], '')"


def first_seen(x: str) -> str:
    return f"list_filter({x}, lambda v, k: list_position({x}, v) = k)"


def shingles(x: str, size: int = 6, limit: int = 16) -> str:
    count = f"(length({x}) - {size - 1})"
    spread = f"list_transform(range(0, least({limit}, greatest({count}, 1))), lambda k: substring({x}, CAST(floor(k * greatest({count}, {limit}) / {float(limit)}) AS INTEGER) + 1, {size}))"
    return f"CASE WHEN {x} = '' THEN [] WHEN length({x}) <= {size} THEN [{x}] ELSE {spread} END"


#: Views in order; each may use those before it.
VIEWS: dict[str, str] = {}

VIEWS["recs"] = """
SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS id, doc_id AS num, CAST(1 + doc_id % 3 AS INTEGER) AS src, lang AS country,
       array_to_string(w[1:4], ' ') AS business_name,
       n_chars || ' ' || array_to_string(w[5:10], ' ') || ', ' || source AS business_address, text
FROM (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents)"""

VIEWS["names"] = f"""
WITH a AS MATERIALIZED (SELECT id, num, src, country, {fold('business_name')} AS f FROM recs),
b AS MATERIALIZED (SELECT *, {trade_name('f')} AS t FROM a),
c AS MATERIALIZED (SELECT *, {strip_junk('t')} AS j FROM b),
d AS MATERIALIZED (SELECT *, {domain_stem('j')} AS dom FROM c),
e AS MATERIALIZED (SELECT *, {words("translate(coalesce(dom, j), '&+', '  ')")} AS w FROM d),
g AS MATERIALIZED (SELECT *, list_transform(w, lambda t: {legal_code('t')}) AS lc FROM e),
h AS MATERIALIZED (SELECT *, list_filter(w, lambda t, i: lc[i] IS NULL) AS core0 FROM g),
k AS MATERIALIZED (SELECT *, CASE WHEN len(core0) = 0 THEN w ELSE core0 END AS core,
     list_sort(list_distinct(list_transform(list_filter(lc, lambda l: l IS NOT NULL), lambda l: coalesce({mapping(tables.LEGAL_EQUAL)}[l], l)))) AS legal FROM h)
SELECT id, num, src, country, f, j, core, legal, dom IS NOT NULL AS is_domain, t <> f AS had_dba,
       {skeleton("array_to_string(core, ' ')")} AS name_skel, {skeleton("array_to_string(core, ' ')", vowels=True)} AS name_squeeze, array_to_string(core, '') AS name_nospace
FROM k"""

VIEWS["addresses"] = f"""
WITH a AS MATERIALIZED (SELECT id, {fold('business_address')} AS f0 FROM recs),
b AS MATERIALIZED (SELECT id, CASE WHEN list_contains([{', '.join(text(x) for x in tables.NO_ADDRESS)}], f0) THEN '' ELSE replace(f0, '<null>', ' ') END AS f FROM a),
c AS MATERIALIZED (SELECT *, list_filter(list_transform({words('f')}, lambda t: {canon_word('t')}), lambda t: t <> '') AS t0 FROM b),
d AS MATERIALIZED (SELECT *, {first_seen('t0')} AS addr_tokens FROM c),
e AS MATERIALIZED (SELECT *, list_filter(addr_tokens, lambda t: regexp_matches(t, '[0-9]')) AS addr_digits,
     list_filter(addr_tokens, lambda t: NOT regexp_matches(t, '[0-9]') AND length(t) > 1) AS addr_alpha FROM d)
SELECT id, f = '' AS addr_empty, addr_tokens, addr_digits, addr_alpha, {postal('f')} AS postal, {house('f')} AS house,
       {skeleton("array_to_string(addr_alpha, ' ')")} AS addr_skel FROM e"""

VIEWS["store"] = "SELECT * FROM names JOIN addresses USING (id)"

VIEWS["truth"] = """
SELECT q.id AS q_id, c.id AS c_id FROM recs q JOIN recs c ON q.country = c.country AND left(q.text, 40) = left(c.text, 40)
WHERE q.src = 1 AND c.src > 1"""

VIEWS["tokens"] = f"""
SELECT id, src, country, x.t AS token, x.w AS w, x.ch AS ch FROM (
  SELECT id, src, country, unnest(
    list_transform(core, lambda t: {{'t': 'n' || t, 'w': 1.0e0, 'ch': 'name'}})
    || list_transform({shingles('name_skel')}, lambda t: {{'t': 'k' || t, 'w': 0.45e0, 'ch': 'name'}})
    || CASE WHEN length(name_nospace) >= 7 THEN [{{'t': 'w' || name_nospace, 'w': 1.6e0, 'ch': 'name'}}] ELSE [] END
    || CASE WHEN length(name_skel) >= 6 THEN [{{'t': 'S' || name_skel, 'w': 1.2e0, 'ch': 'name'}}] ELSE [] END
    || list_transform(addr_alpha, lambda t: {{'t': 'a' || t, 'w': 0.85e0, 'ch': 'addr'}})
    || list_transform(addr_digits, lambda t: {{'t': 'd' || t, 'w': 1.0e0, 'ch': 'addr'}})
    || CASE WHEN house <> '' THEN list_transform(addr_alpha[1:3], lambda t: {{'t': 'H' || house || '|' || t, 'w': 1.3e0, 'ch': 'addr'}}) ELSE [] END
    || CASE WHEN len(addr_digits) >= 2 THEN [{{'t': 'D' || array_to_string(list_sort(addr_digits), ','), 'w': 1.5e0, 'ch': 'addr'}}] ELSE [] END
  ) AS x FROM store)"""

VIEWS["df"] = "SELECT country, ch, token, count(DISTINCT id) AS df FROM tokens GROUP BY country, ch, token"
VIEWS["docs_in"] = "SELECT country, count(*) AS n FROM store GROUP BY country"
_CAP = "CASE WHEN ch = 'name' THEN CASE left(token, 1) WHEN 'k' THEN 2500 WHEN 'w' THEN 400 WHEN 'S' THEN 400 ELSE 8000 END ELSE CASE left(token, 1) WHEN 'H' THEN 400 WHEN 'D' THEN 400 ELSE 12000 END END"
VIEWS["idf"] = f"SELECT country, ch, token, df, ln((n + 1.0e0) / (df + 1.0e0)) + 1.0e0 AS idf FROM df JOIN docs_in USING (country) WHERE df BETWEEN 1 AND {_CAP}"
VIEWS["postings"] = """
SELECT id, src, country, ch, token, v / sqrt(sum(v * v) OVER (PARTITION BY id, ch)) AS w
FROM (SELECT id, src, country, ch, token, max(w) * any_value(idf) AS v FROM tokens JOIN idf USING (country, ch, token) GROUP BY id, src, country, ch, token)"""


def _channel(ch: str, floor: str, k: int) -> str:
    return f"""
SELECT q_id, c_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS rn FROM (
    SELECT q.id AS q_id, c.id AS c_id, round(sum(q.w * c.w), 6) AS score
    FROM postings q JOIN postings c ON q.country = c.country AND q.ch = c.ch AND q.token = c.token
    WHERE q.src = 1 AND c.src > 1 AND q.ch = '{ch}' GROUP BY q.id, c.id) WHERE score >= {floor})
WHERE rn <= {k}"""


VIEWS["name_cands"] = _channel("name", "0.03e0", 45)
VIEWS["addr_cands"] = _channel("addr", "0.055e0", 40)
VIEWS["cands"] = """
SELECT q_id, c_id, score, mask, CAST(rn - 1 AS INTEGER) AS cand_rank, count(*) OVER (PARTITION BY q_id) AS cand_count FROM (
  SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS rn FROM (
    SELECT q_id, c_id, max(score) AS score, CAST(bit_or(m) AS INTEGER) AS mask
    FROM (SELECT *, 1 AS m FROM name_cands UNION ALL SELECT *, 2 AS m FROM addr_cands) GROUP BY q_id, c_id))
WHERE rn <= 72"""
VIEWS["scored"] = """
SELECT c.*, least(0.999e0, score) AS p, CAST(t.c_id IS NOT NULL AS INTEGER) AS label
FROM cands c LEFT JOIN (SELECT DISTINCT q_id, c_id FROM truth) t USING (q_id, c_id)"""
VIEWS["pairs"] = """
SELECT s.*, CAST(b.src AS INTEGER) AS src, a.core AS qn, b.core AS cn, a.name_skel AS qk, b.name_skel AS ck, a.name_nospace AS qw, b.name_nospace AS cw, a.legal AS ql, b.legal AS cl,
       a.addr_alpha AS qa, b.addr_alpha AS ca, a.addr_digits AS qd, b.addr_digits AS cd, a.postal AS qp, b.postal AS cp, a.house AS qh, b.house AS ch, a.country AS country
FROM scored s JOIN store a ON s.q_id = a.id JOIN store b ON s.c_id = b.id"""
VIEWS["truth_sizes"] = "SELECT id AS q_id, country, coalesce(n, 0) AS t_size FROM (SELECT id, country FROM recs WHERE src = 1) LEFT JOIN (SELECT q_id AS id, count(DISTINCT c_id) AS n FROM truth GROUP BY q_id) USING (id)"


def needs(name: str, body: str) -> list[str]:
    import re

    return [v for v in VIEWS if v != name and re.search(rf"\b(?:FROM|JOIN)\s+{v}\b", body)]


def query(body: str) -> str:
    """`body` behind the views it needs, in order."""
    wanted: set[str] = set()
    todo = needs("", body)
    while todo:
        v = todo.pop()
        if v not in wanted:
            wanted.add(v)
            todo += needs(v, VIEWS[v])
    parts = [f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in VIEWS if v in wanted]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        # The query's own steps follow the views.
        return "WITH " + ",\n".join([*parts, body[5:]])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
