"""SQL counterparts of the queries, for an independent engine (DuckDB dialect).

Shared steps are named common table expressions; each query lists only its own
last step, and ``_compose`` puts the steps it needs in front of it.
"""

from __future__ import annotations

import re

from tagweave.functions.stemming import STEP_2, STEP_3, STEP_4
from tagweave.functions.stopwords import ENGLISH
from tagweave.operators.split import TEST, TRAINING, VALIDATION
from tagweave.options import Options
from tagweave.plans.queries import (
    DEFAULTS,
    LABEL_CAP,
    LABEL_RULES,
    LOOKED_UP,
    NGRAM,
    SAMPLE_SEED,
    SAMPLE_SHARE,
    SHARD_ROWS,
    TAG_FRACTION,
    TEXT_RULES,
)


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STEPS: dict[str, str] = {}
ORACLES: dict[str, str] = {}
STOP_LIST = ", ".join(_quote(w) for w in ENGLISH)
# Written out here, so that an error in the library's own patterns shows.
FORMULA = r"\$\$.*?\$\$|\$.*?\$|\\begin.*?\\end\{.*?\}"
MATH = _quote(FORMULA)
WORD = _quote(r"[\p{L}\p{N}]+")


def _needed(sql: str, seen: list[str], own: str = "") -> list[str]:
    for name in re.findall(r"\bc_\w+", sql):
        if name in STEPS and name not in seen and name != own:
            _needed(STEPS[name], seen, name)
            seen.append(name)
    return seen


def _compose(sql: str) -> str:
    steps = _needed(sql, [])
    head = ",\n".join(f"{name} AS (\n{STEPS[name]}\n)" for name in steps)
    return f"WITH RECURSIVE {head}\n{sql}" if steps else sql


def _draw(key: str, opts: Options = DEFAULTS) -> str:
    return f"(('0x' || substr(md5('{opts.seed}:' || {key}), 1, 8))::BIGINT)"


def _set(key: str, opts: Options = DEFAULTS) -> str:
    share = f"{_draw(key, opts)}::DOUBLE / 4294967296::DOUBLE"
    return (
        f"CASE WHEN {share} < CAST('{opts.training_share!r}' AS DOUBLE) THEN '{TRAINING}' "
        f"WHEN {share} < CAST('{opts.test_bound!r}' AS DOUBLE) THEN '{TEST}' ELSE '{VALIDATION}' END"
    )


def _text_of(values: str, separator: str = " ") -> str:
    return f"coalesce(array_to_string({values}, '{separator}'), '')"


# Text

STEPS["c_raw"] = """
SELECT doc_id AS "uniqueID",
       CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS title,
       CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS body,
       lang AS domain
FROM documents"""
STEPS["c_text"] = f"""
SELECT "uniqueID",
       regexp_replace(coalesce(title, ''), {MATH}, '', 'g') AS title,
       regexp_replace(coalesce(body, ''), {MATH}, '', 'g') AS body,
       replace(coalesce(domain, ''), chr(13), '') AS domain,
       {_set('"uniqueID"')} AS "set"
FROM c_raw"""
STEPS["c_doc"] = r"""
SELECT * REPLACE (trim(regexp_replace(title, '\s+', ' ', 'g')) AS title,
                  trim(regexp_replace(body, '\s+', ' ', 'g')) AS body)
FROM c_text"""
STEPS["c_word"] = f"""
SELECT * REPLACE (regexp_extract_all(title, {WORD}) AS title, regexp_extract_all(body, {WORD}) AS body) FROM c_doc"""


def _no_stop(values: str) -> str:
    return f"list_filter({values}, lambda t: lower(t) NOT IN ({STOP_LIST}))"


def _letters(values: str) -> str:
    cleaned = f"list_transform({values}, lambda t: regexp_replace(lower(t), '[^\\p{{L}}]', '', 'g'))"
    return f"list_filter({cleaned}, lambda t: t <> '')"


def _grams(values: str) -> str:
    n = NGRAM
    return f"list_transform(range(1, len({values}) - {n} + 2), lambda i: array_to_string({values}[i:i + {n} - 1], ' '))"


STEPS["c_token"] = f"SELECT * REPLACE ({_no_stop('title')} AS title, {_no_stop('body')} AS body) FROM c_word"
STEPS["c_letter"] = f"SELECT * REPLACE ({_letters('title')} AS title, {_letters('body')} AS body) FROM c_word"
STEPS["c_normal"] = f"SELECT * REPLACE ({_no_stop('title')} AS title, {_no_stop('body')} AS body) FROM c_letter"

ORACLES["clean_text"] = 'SELECT "uniqueID", title, body, domain FROM c_text'
DOTALL = _quote("(?s)" + FORMULA)
ORACLES["clean_text_dotall"] = f"""
SELECT "uniqueID", regexp_replace(coalesce(title, ''), {DOTALL}, '', 'g') AS title,
       regexp_replace(coalesce(body, ''), {DOTALL}, '', 'g') AS body
FROM c_raw"""
ORACLES["distinct_domains"] = "SELECT DISTINCT domain FROM c_text"
ORACLES["documents_assembled"] = 'SELECT "uniqueID", title, body FROM c_doc'


def _sentences(field: str) -> str:
    found = f"regexp_extract_all({field}, '[^.!?]+[.!?]*')"
    return f"list_filter(list_transform({found}, lambda s: trim(s)), lambda s: s <> '')"


STEPS["c_sentence"] = f"""
SELECT "uniqueID", {_sentences('title')} AS title, {_sentences('body')} AS body FROM c_doc"""
ORACLES["sentences"] = f"""
SELECT "uniqueID", len(title)::BIGINT AS n_title, len(body)::BIGINT AS n_body,
       {_text_of('title', '|')} AS title, {_text_of('body', '|')} AS body FROM c_sentence"""


def _token_query(step: str) -> str:
    return f'SELECT "uniqueID", {_text_of("title")} AS title, {_text_of("body")} AS body FROM {step}'


ORACLES["tokens"] = _token_query("c_word")
SYMBOL = _quote(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")
STEPS["c_symbol"] = f"""
SELECT * REPLACE (regexp_extract_all(title, {SYMBOL}) AS title, regexp_extract_all(body, {SYMBOL}) AS body) FROM c_doc"""
ORACLES["tokens_punctuation"] = _token_query("c_symbol")
ORACLES["tokens_normalized"] = _token_query("c_normal")
ORACLES["stopwords"] = _token_query("c_token")
ORACLES["ngrams"] = f"""
SELECT "uniqueID", {_text_of(_grams('title'), '|')} AS title, {_text_of(_grams('body'), '|')} AS body FROM c_token"""
STEPS["c_merged"] = f"""
SELECT "uniqueID", title || {_grams('title')} || body || {_grams('body')} AS terms FROM c_token"""
ORACLES["ngrams_merged"] = f"""
SELECT "uniqueID", len(terms)::BIGINT AS terms, {_text_of('terms', '|')} AS "titleBody" FROM c_merged"""

# Stemming: the published rules as regular expressions over distinct words. A
# consonant y is written Y first, so that letters alone decide what is a vowel.

SOME = "'^[^aeiouy]*[aeiouy]+[^aeiouy]'"
MORE = "'^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]'"
SHORT = "'[^aeiouy][aeiouy][^aeiouywxY]$'"


def _cut(word: str, suffix: str) -> str:
    return f"left({word}, -{len(suffix)})"


def _rules(table: dict[str, str]) -> str:
    cases = [
        f"WHEN w LIKE '%{s}' THEN CASE WHEN regexp_matches({_cut('w', s)}, {SOME}) THEN {_cut('w', s)} || '{table[s]}' ELSE w END"
        for s in sorted(table, key=len, reverse=True)
    ]
    return "CASE WHEN length(token) <= 2 THEN w " + " ".join(cases) + " ELSE w END"


def _drops() -> str:
    cases = []
    for s in sorted(STEP_4, key=len, reverse=True):
        stem = _cut("w", s)
        extra = f" AND regexp_matches({stem}, '[st]$')" if s == "ion" else ""
        cases.append(f"WHEN w LIKE '%{s}' THEN CASE WHEN regexp_matches({stem}, {MORE}){extra} THEN {stem} ELSE w END")
    return "CASE WHEN length(token) <= 2 THEN w " + " ".join(cases) + " ELSE w END"


STEPS["c_distinct"] = """
SELECT DISTINCT token FROM (SELECT unnest(title) AS token FROM c_letter UNION ALL SELECT unnest(body) FROM c_letter)"""
STEPS["c_stem0"] = r"""
SELECT token, regexp_replace(regexp_replace(token, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w FROM c_distinct"""
STEPS["c_stem1"] = """
SELECT token, CASE WHEN length(token) <= 2 THEN w
                   WHEN w LIKE '%sses' OR w LIKE '%ies' THEN left(w, -2)
                   WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN left(w, -1) ELSE w END AS w
FROM c_stem0"""
STEPS["c_stem2"] = f"""
SELECT token, w,
       CASE WHEN length(token) <= 2 OR w LIKE '%eed' THEN NULL
            WHEN w LIKE '%ed' AND regexp_matches(left(w, -2), '[aeiouy]') THEN left(w, -2)
            WHEN w LIKE '%ing' AND regexp_matches(left(w, -3), '[aeiouy]') THEN left(w, -3) END AS s
FROM c_stem1"""
STEPS["c_stem3"] = f"""
SELECT token,
       CASE WHEN length(token) <= 2 THEN w
            WHEN w LIKE '%eed' THEN CASE WHEN regexp_matches(left(w, -3), {SOME}) THEN left(w, -1) ELSE w END
            WHEN s IS NULL THEN w
            WHEN s LIKE '%at' OR s LIKE '%bl' OR s LIKE '%iz' THEN s || 'e'
            WHEN length(s) > 1 AND lower(right(s, 1)) = lower(left(right(s, 2), 1)) AND regexp_matches(s, '[^aeiouylsz]$')
                THEN left(s, -1)
            WHEN regexp_matches(s, {SOME}) AND NOT regexp_matches(s, {MORE}) AND regexp_matches(s, {SHORT}) THEN s || 'e'
            ELSE s END AS w
FROM c_stem2"""
STEPS["c_stem4"] = """
SELECT token, CASE WHEN length(token) > 2 AND regexp_matches(w, '[yY]$') AND regexp_matches(left(w, -1), '[aeiouy]')
                   THEN left(w, -1) || 'i' ELSE w END AS w
FROM c_stem3"""
STEPS["c_stem5"] = f"SELECT token, {_rules(STEP_2)} AS w FROM c_stem4"
STEPS["c_stem6"] = f"SELECT token, {_rules(STEP_3)} AS w FROM c_stem5"
STEPS["c_stem7"] = f"SELECT token, {_drops()} AS w FROM c_stem6"
STEPS["c_stem8"] = f"""
SELECT token, CASE WHEN length(token) > 2 AND w LIKE '%e'
                    AND (regexp_matches(left(w, -1), {MORE})
                         OR (regexp_matches(left(w, -1), {SOME}) AND NOT regexp_matches(left(w, -1), {SHORT})))
                   THEN left(w, -1) ELSE w END AS w
FROM c_stem7"""
STEPS["c_stem"] = f"""
SELECT token, lower(CASE WHEN length(token) > 2 AND w LIKE '%ll' AND regexp_matches(w, {MORE}) THEN left(w, -1) ELSE w END) AS stem
FROM c_stem8"""
ORACLES["stems"] = "SELECT token, stem FROM c_stem"
STEPS["c_place"] = """
SELECT "uniqueID", 'title' AS field, unnest(title) AS token, generate_subscripts(title, 1) AS pos FROM c_letter
UNION ALL
SELECT "uniqueID", 'body', unnest(body), generate_subscripts(body, 1) FROM c_letter"""
STEPS["c_stemmed"] = f"""
SELECT p."uniqueID", p.field, string_agg(s.stem, ' ' ORDER BY p.pos) AS words
FROM c_place p JOIN c_stem s USING (token) WHERE lower(s.stem) NOT IN ({STOP_LIST}) GROUP BY ALL"""
ORACLES["tokens_stemmed"] = """
SELECT t."uniqueID", coalesce(a.words, '') AS title, coalesce(b.words, '') AS body
FROM c_text t
LEFT JOIN c_stemmed a ON a."uniqueID" = t."uniqueID" AND a.field = 'title'
LEFT JOIN c_stemmed b ON b."uniqueID" = t."uniqueID" AND b.field = 'body'"""

ORACLES["token_hash"] = """
SELECT count(DISTINCT token) AS tokens, count(DISTINCT token) AS xxhash64, count(DISTINCT token) AS murmur3_128
FROM (SELECT unnest(title || body) AS token FROM c_token)"""

# MurmurHash3 x64 128 over UTF-16 code units, by 128-bit integers cut to 64 bits. The constants
# are the published ones, written out here as well.
_C1, _C2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
_ADD1, _ADD2 = 0x52DCE729, 0x38495AB5
_MIX1, _MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_WIDTH = f"{1 << 64}::UHUGEINT"


def _times(x: str, factor: int) -> str:
    return f"(({x})::UHUGEINT * {factor}::UHUGEINT % {_WIDTH})::UBIGINT"


def _plus(x: str, y: str | int) -> str:
    return f"((({x})::UHUGEINT + ({y})::UHUGEINT) % {_WIDTH})::UBIGINT"


def _turned(x: str, bits: int) -> str:
    return f"((({x})::UHUGEINT * {1 << bits}::UHUGEINT % {_WIDTH}) + ({x})::UHUGEINT // {1 << (64 - bits)}::UHUGEINT)::UBIGINT"


def _folded(x: str) -> str:
    return f"xor({x}, {x} // {1 << 33}::UBIGINT)"


def _scrambled(first: int, bits: int, second: int) -> str:
    steps = (_times("x", first), _turned("x", bits), _times("x", second))
    sql = "lanes"
    for step in steps:
        sql = f"list_transform({sql}, lambda x: {step})"
    return sql


_LANE = " + ".join(f"coalesce(units[4 * j + {i + 1}], 0)::UHUGEINT * {65536**i}::UHUGEINT" for i in range(4))
STEPS["c_unit"] = """
SELECT token, flatten(list_transform(range(1, length(token) + 1), lambda i:
         CASE WHEN unicode(substr(token, i, 1)) < 65536 THEN [unicode(substr(token, i, 1))]
              ELSE [55296 + (unicode(substr(token, i, 1)) - 65536) // 1024, 56320 + (unicode(substr(token, i, 1)) - 65536) % 1024] END)) AS units
FROM (SELECT DISTINCT unnest(title || body) AS token FROM c_token)"""
STEPS["c_lane"] = f"""
SELECT token, len(units) AS n, list_transform(range(0, (len(units) + 3) // 4), lambda j: ({_LANE})::UBIGINT) AS lanes FROM c_unit"""
STEPS["c_scrambled"] = f"""
SELECT token, n, {_scrambled(_C1, 31, _C2)} AS odd, {_scrambled(_C2, 33, _C1)} AS even FROM c_lane"""
STEPS["c_block"] = f"""
SELECT token, n, odd, even, 0 AS i, 0::UBIGINT AS h1, 0::UBIGINT AS h2 FROM c_scrambled
UNION ALL
SELECT token, n, odd, even, i + 1, g, {_plus(_times(_plus(_turned('xor(h2, even[2 * i + 2])', 31), 'g'), 5), _ADD2)}
FROM (SELECT *, {_plus(_times(_plus(_turned('xor(h1, odd[2 * i + 1])', 27), 'h2'), 5), _ADD1)} AS g FROM c_block WHERE i < n // 8)"""
STEPS["c_tail"] = """
SELECT token, (2 * n)::UBIGINT AS size,
       CASE WHEN n % 8 > 0 THEN xor(h1, odd[2 * i + 1]) ELSE h1 END AS h1,
       CASE WHEN n % 8 > 4 THEN xor(h2, even[2 * i + 2]) ELSE h2 END AS h2
FROM c_block WHERE i = n // 8"""
STEPS["c_joined1"] = f"SELECT token, {_plus('xor(h1, size)', 'xor(h2, size)')} AS a, xor(h2, size) AS b FROM c_tail"
STEPS["c_joined2"] = f"SELECT token, a, {_plus('b', 'a')} AS b FROM c_joined1"
STEPS["c_mixed1"] = f"SELECT token, {_times(_folded('a'), _MIX1)} AS a, {_times(_folded('b'), _MIX1)} AS b FROM c_joined2"
STEPS["c_mixed2"] = f"SELECT token, {_times(_folded('a'), _MIX2)} AS a, {_times(_folded('b'), _MIX2)} AS b FROM c_mixed1"
STEPS["c_murmur"] = f"SELECT token, {_plus(_folded('a'), _folded('b'))} AS h FROM c_mixed2"
ORACLES["token_hash_values"] = f"""
SELECT token, CASE WHEN h < {1 << 63}::UBIGINT THEN h::BIGINT ELSE (h::HUGEINT - {1 << 64}::HUGEINT)::BIGINT END AS murmur FROM c_murmur"""
STEPS["c_occurrence"] = """
SELECT "uniqueID", field, count(*) AS d, sum(n)::BIGINT AS total, max(n) AS most
FROM (SELECT "uniqueID", field, token, count(*) AS n
      FROM (SELECT "uniqueID", 'title' AS field, unnest(title) AS token FROM c_token
            UNION ALL SELECT "uniqueID", 'body', unnest(body) FROM c_token)
      GROUP BY ALL)
GROUP BY ALL"""
ORACLES["token_occurrences"] = """
SELECT t."uniqueID", t.domain, coalesce(e."originalTagCount", 0)::INTEGER AS "originalTagCount",
       coalesce(a.d, 0) AS title_distinct, coalesce(a.total, 0) AS title_total, coalesce(a.most, 0) AS title_most,
       coalesce(b.d, 0) AS body_distinct, coalesce(b.total, 0) AS body_total, coalesce(b.most, 0) AS body_most
FROM c_text t
LEFT JOIN c_encoded e ON e."uniqueID" = t."uniqueID"
LEFT JOIN c_occurrence a ON a."uniqueID" = t."uniqueID" AND a.field = 'title'
LEFT JOIN c_occurrence b ON b."uniqueID" = t."uniqueID" AND b.field = 'body'"""
ORACLES["token_counts"] = f"""
SELECT token, count(*) AS "tokenCount"
FROM (SELECT unnest(title || body) AS token FROM c_token WHERE "set" = '{TRAINING}') GROUP BY token"""

# Tags and split

STEPS["c_tag"] = f"""
SELECT g."uniqueID", g.tags, coalesce(d.lang, o.o_orderpriority, 'undefined_domain') AS domain, {_set('g."uniqueID"')} AS "set"
FROM (SELECT l_orderkey AS "uniqueID", string_agg(p_brand, ',' ORDER BY l_returnflag, p_brand) AS tags
      FROM (SELECT DISTINCT l_orderkey, l_returnflag, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)
      GROUP BY l_orderkey) g
LEFT JOIN documents d ON d.doc_id = g."uniqueID"
LEFT JOIN orders o ON o.o_orderkey = g."uniqueID\""""
STEPS["c_parts"] = """
SELECT *, list_filter(list_transform(string_split(tags, ','), lambda t: trim(t)), lambda t: t <> '') AS parts FROM c_tag"""
STEPS["c_tagset"] = """
SELECT "uniqueID", domain, "set", list_filter(parts, lambda t, i: list_position(parts, t) = i) AS tagset FROM c_parts"""
STEPS["c_exploded"] = 'SELECT "uniqueID", domain, "set", unnest(tagset) AS tag FROM c_tagset'
STEPS["c_count"] = f"""
SELECT domain, tag, count(*) AS n FROM c_exploded WHERE "set" = '{TRAINING}' GROUP BY domain, tag"""
STEPS["c_domain"] = """
SELECT domain, tag, n, (row_number() OVER (PARTITION BY domain ORDER BY n DESC, tag) - 1)::INTEGER AS r FROM c_count"""
STEPS["c_global"] = """
SELECT tag, n, (row_number() OVER (ORDER BY n DESC, tag) - 1)::INTEGER AS r
FROM (SELECT tag, sum(n)::BIGINT AS n FROM c_count GROUP BY tag)"""
STEPS["c_encoded"] = """
SELECT e."uniqueID", list(DISTINCT g.r ORDER BY g.r) FILTER (g.r IS NOT NULL) AS globals,
       list(DISTINCT d.r ORDER BY d.r) FILTER (d.r IS NOT NULL) AS domains,
       list(DISTINCT g.tag ORDER BY g.tag) FILTER (g.tag IS NOT NULL) AS global_names,
       list(DISTINCT d.tag ORDER BY d.tag) FILTER (d.tag IS NOT NULL) AS domain_names,
       count(DISTINCT e.tag) AS "originalTagCount", max(e.domain) AS domain, max(e."set") AS "set"
FROM c_exploded e
LEFT JOIN c_global g ON g.tag = e.tag
LEFT JOIN c_domain d ON d.tag = e.tag AND d.domain = e.domain
GROUP BY e."uniqueID\""""

ORACLES["split_assign"] = 'SELECT "uniqueID", "set" FROM c_tag'
ORACLES["split_text"] = """
SELECT "uniqueID", domain, "set" FROM c_text WHERE "uniqueID" IN (SELECT "uniqueID" FROM c_tag)"""
STEPS["c_share"] = """
SELECT "set", count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM c_tag) AS share FROM c_tag GROUP BY "set\""""
ORACLES["split_shares"] = 'SELECT "set", n AS "rows", round(share, 6) AS share FROM c_share'
ORACLES["share_violations"] = f"""
SELECT count(*) AS violations
FROM c_share JOIN (VALUES ('{TRAINING}', {DEFAULTS.training_share}), ('{TEST}', {DEFAULTS.test_share}),
                          ('{VALIDATION}', {DEFAULTS.validation_share})) w(name, wanted) ON name = "set"
WHERE abs(share - wanted) > 0.2 * wanted"""
ORACLES["tag_sets"] = f"""
SELECT "uniqueID", domain, {_text_of('tagset', ',')} AS "tagSet", len(tagset)::BIGINT AS "uniqueTagCount" FROM c_tagset"""
ORACLES["tag_explode"] = 'SELECT "uniqueID", domain, tag FROM c_exploded'
ORACLES["tag_counts"] = 'SELECT domain, tag, n AS "tagInDomainCount" FROM c_count'
ORACLES["tag_rank_domain"] = 'SELECT domain, tag, n AS "tagInDomainCount", r AS "tagRankInDomain" FROM c_domain'
ORACLES["tag_rank_global"] = 'SELECT tag, n AS "tagGlobalCount", r AS "tagGlobalRank" FROM c_global ORDER BY r'
ORACLES["tags_per_domain"] = "SELECT domain, count(*) AS tags FROM c_count GROUP BY domain"
ORACLES["tag_fraction"] = f"""
SELECT domain, tag, n AS "tagInDomainCount", r AS "tagRankInDomain" FROM c_domain
QUALIFY r < ceil({TAG_FRACTION} * count(*) OVER (PARTITION BY domain))"""
ORACLES["rank_gaps"] = """
SELECT domain, count(*) AS tags, count(*) FILTER (r - previous <> 1) AS gaps, count(*) FILTER (r = previous) AS repeats
FROM (SELECT domain, r, lag(r) OVER (PARTITION BY domain ORDER BY r) AS previous FROM c_domain) GROUP BY domain"""
ORACLES["tag_encode"] = f"""
SELECT "uniqueID", {_text_of('globals')} AS "globalTags", {_text_of('domains')} AS "domainTags", "originalTagCount", domain
FROM c_encoded"""
ORACLES["label_decode"] = f"""
SELECT "uniqueID", {_text_of('global_names', ',')} AS "globalNames", {_text_of('domain_names', ',')} AS "domainNames"
FROM c_encoded WHERE len(globals) > 0 OR len(domains) > 0"""
ORACLES["label_agreement"] = """
SELECT count(*) AS posts, count(*) FILTER (global_names IS DISTINCT FROM domain_names) AS different
FROM c_encoded WHERE len(globals) > 0 OR len(domains) > 0"""
ORACLES["top_labels"] = f"""
SELECT "uniqueID", {_text_of(f'list_filter(domains, lambda r: r < {LABEL_CAP})')} AS labels FROM c_encoded"""

# Dictionary

STEPS["c_dictionary"] = f"""
SELECT token, (row_number() OVER (ORDER BY n DESC, token) - 1)::INTEGER AS i
FROM (SELECT token, count(*) AS n
      FROM (SELECT unnest(title || body) AS token FROM c_token
            WHERE "set" = '{TRAINING}' AND "uniqueID" IN (SELECT "uniqueID" FROM c_tag))
      GROUP BY token HAVING count(*) > {DEFAULTS.token_usage_threshold})"""
STEPS["c_fields"] = """
SELECT "uniqueID", 'title' AS field, title AS original FROM c_text UNION ALL SELECT "uniqueID", 'body', body FROM c_text"""
STEPS["c_position"] = """
SELECT "uniqueID", 'title' AS field, unnest(title) AS token, generate_subscripts(title, 1) AS pos FROM c_token
UNION ALL
SELECT "uniqueID", 'body', unnest(body), generate_subscripts(body, 1) FROM c_token"""
STEPS["c_missing"] = """
SELECT t."uniqueID", t.field, any_value(t.original) AS original,
       coalesce(string_agg(coalesce(d.token, 'NOTFOUND'), ',' ORDER BY p.pos) FILTER (p.pos IS NOT NULL), '') AS recovered
FROM c_fields t LEFT JOIN c_position p ON p."uniqueID" = t."uniqueID" AND p.field = t.field
LEFT JOIN c_dictionary d ON d.token = p.token
GROUP BY t."uniqueID", t.field"""
ORACLES["token_dictionary"] = 'SELECT token, i AS "index" FROM c_dictionary'
ORACLES["decode_known"] = """
SELECT "uniqueID", field, string_agg(token, ',' ORDER BY pos) AS recovered
FROM c_position JOIN c_dictionary USING (token) GROUP BY "uniqueID", field"""
ORACLES["decode_missing"] = 'SELECT "uniqueID", field, recovered FROM c_missing'
ORACLES["decode_compare"] = 'SELECT "uniqueID", field, recovered, original FROM c_missing'

# Features


def _vocabulary(source: str, opts: Options) -> str:
    return f"""
SELECT term, tf, df, (row_number() OVER (ORDER BY tf DESC, term) - 1)::INTEGER AS r
FROM (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM {source} GROUP BY term HAVING count(*) >= {opts.min_df})
QUALIFY r < {opts.vocab_size}"""


STEPS["c_term"] = """
SELECT "uniqueID", "set", term, count(*) AS n
FROM (SELECT "uniqueID", "set", unnest(title || body) AS term FROM c_token) GROUP BY ALL"""
STEPS["c_field_term"] = """
SELECT "uniqueID", field, term, count(*) AS n
FROM (SELECT "uniqueID", 'title' AS field, unnest(title) AS term FROM c_token
      UNION ALL SELECT "uniqueID", 'body', unnest(body) FROM c_token) GROUP BY ALL"""
STEPS["c_vocabulary"] = _vocabulary("c_term", DEFAULTS)
STEPS["c_weight"] = """
SELECT term, r, df, ln(((SELECT count(*) FROM c_text) + 1)::DOUBLE / (df + 1)) AS weight FROM c_vocabulary"""
ORACLES["vocabulary"] = 'SELECT term AS words, r AS "rank", tf, df FROM c_vocabulary'
STEPS["c_training_term"] = f"SELECT * FROM c_term WHERE \"set\" = '{TRAINING}'"
STEPS["c_training_vocabulary"] = _vocabulary("c_training_term", DEFAULTS)
ORACLES["vocabulary_training"] = f"""
SELECT term AS words, r AS "rank", (SELECT count(*) FROM c_text WHERE "set" = '{TRAINING}') AS posts FROM c_training_vocabulary"""
STEPS["c_gram_term"] = f"""
SELECT "uniqueID", term, count(*) AS n
FROM (SELECT "uniqueID", unnest(title || {_grams('title')} || body || {_grams('body')}) AS term FROM c_normal) GROUP BY ALL"""
STEPS["c_gram_vocabulary"] = _vocabulary("c_gram_term", Options(vocab_size=1000))
ORACLES["vocabulary_ngrams"] = 'SELECT term AS words, r AS "rank" FROM c_gram_vocabulary'
_BAG = 'SELECT "uniqueID", r AS "rank", n FROM c_term JOIN c_vocabulary USING (term)'
ORACLES["bag_combined"] = _BAG
ORACLES["bag_vectors"] = _BAG
ORACLES["bag_separate"] = 'SELECT "uniqueID", field, r AS "rank", n FROM c_field_term JOIN c_vocabulary USING (term)'
ORACLES["bag_decode"] = """
SELECT "uniqueID", string_agg(term, ',' ORDER BY r) AS words FROM c_term JOIN c_vocabulary USING (term) GROUP BY "uniqueID\""""
ORACLES["idf"] = 'SELECT term AS words, r AS "rank", df, round(weight, 6) AS weight FROM c_weight'
ORACLES["tfidf"] = 'SELECT "uniqueID", r AS "rank", round(n * weight, 6) AS tfidf FROM c_term JOIN c_weight USING (term)'
ORACLES["tfidf_separate_vectors"] = """
SELECT "uniqueID", field, r AS "rank", round(n * weight, 6) AS tfidf FROM c_field_term JOIN c_weight USING (term)"""

# Samples

STEPS["c_sample"] = """
SELECT t."uniqueID", t.domain, t."set", t.title, t.body,
       coalesce(e.globals, []) AS globals, coalesce(e.domains, []) AS domains,
       coalesce(e."originalTagCount", 0)::BIGINT AS "originalTagCount"
FROM c_token t LEFT JOIN c_encoded e ON e."uniqueID" = t."uniqueID\""""
_COLUMNS = f"""
       {_text_of('globals')} AS "globalLabels", {_text_of('domains')} AS "domainSpecificLabels",
       "originalTagCount", len(title)::BIGINT AS title_tokens, len(body)::BIGINT AS body_tokens"""


def _shard(source: str, rows: int = DEFAULTS.rows_per_shard) -> str:
    return f"""
SELECT *, {_draw('"uniqueID"')} % ceil(count(*) OVER (PARTITION BY domain, "set") / {rows}::DOUBLE)::BIGINT AS rng
FROM {source}"""


ORACLES["assembled_samples"] = f'SELECT "uniqueID", domain, "set", {_COLUMNS} FROM c_sample'
STEPS["c_sum"] = """
SELECT "uniqueID", sum(n * weight) AS weight, string_agg(r::VARCHAR, ' ' ORDER BY r) AS ranks
FROM c_term JOIN c_weight USING (term) GROUP BY "uniqueID\""""
ORACLES["samples_with_features"] = """
SELECT s."uniqueID", s."set", w.r AS "rank", round(n * weight, 6) AS tfidf
FROM c_sample s LEFT JOIN (c_term JOIN c_weight USING (term)) w ON w."uniqueID" = s."uniqueID\""""
STEPS["c_tagged"] = 'SELECT * FROM c_sample WHERE "uniqueID" IN (SELECT "uniqueID" FROM c_tag)'
STEPS["c_tagged_shard"] = _shard("c_tagged")
ORACLES["prepare"] = f"""
SELECT s."uniqueID", domain, "set", {_COLUMNS}, rng, round(coalesce(w.weight, 0), 4) AS weight,
       coalesce(w.ranks, '') AS ranks
FROM c_tagged_shard s LEFT JOIN c_sum w ON w."uniqueID" = s."uniqueID\""""
ORACLES["samples_csv"] = f"""
SELECT "uniqueID", {_text_of('globals')} AS "globalLabels", {_text_of('domains')} AS "domainSpecificLabels",
       len(title)::BIGINT AS title_tokens, len(body)::BIGINT AS body_tokens FROM c_sample"""
STEPS["c_sample_shard"] = _shard("c_sample")
ORACLES["partitioned_scan"] = f"""
SELECT "uniqueID", domain, "set", {_COLUMNS}, rng::INTEGER AS rng
FROM c_sample_shard WHERE domain = 'en' AND "set" = '{TRAINING}'"""
STEPS["c_tag_shard"] = _shard("c_tag", SHARD_ROWS)
ORACLES["shards"] = 'SELECT domain, "set", rng, count(*) AS "rows" FROM c_tag_shard GROUP BY ALL'
ORACLES["shards_exact"] = f"""
SELECT "uniqueID", domain, "set",
       ((row_number() OVER (PARTITION BY domain, "set" ORDER BY "uniqueID") - 1) // {SHARD_ROWS})::BIGINT AS rng
FROM c_tag"""
ORACLES["run_report"] = """
SELECT 'tags_in_domain' AS metric, domain AS key, count(*) AS value FROM c_count GROUP BY domain
UNION ALL SELECT 'dictionary_tokens', '', count(*) FROM c_dictionary
UNION ALL SELECT 'global_tags', '', count(*) FROM c_global
UNION ALL SELECT 'samples', '', count(*) FROM c_tagged
UNION ALL SELECT 'bag_vocabulary', '', count(*) FROM c_vocabulary"""

# Mining


def _minimum(baskets: str, opts: Options) -> str:
    posts = f"(SELECT count(*) FROM {baskets} WHERE \"set\" = '{TRAINING}')"
    share = f"{opts.support_count}::DOUBLE / {posts}" if opts.min_support is None else f"{opts.min_support}::DOUBLE"
    return f"ceil(({share}) * {posts})"


def _rules_of(itemsets: str, opts: Options) -> str:
    return f"""
SELECT w.antecedent, w.consequent, w.freq::DOUBLE / a.freq AS confidence
FROM (SELECT list_filter(items, lambda x: x <> consequent) AS antecedent, consequent, freq
      FROM (SELECT items, unnest(items) AS consequent, freq FROM {itemsets} WHERE len(items) > 1)) w
JOIN {itemsets} a ON a.items = w.antecedent
WHERE w.freq::DOUBLE / a.freq >= {opts.min_confidence}"""


STEPS["c_text_basket"] = f"""
SELECT t."uniqueID" AS id, t."set", list_transform(list_distinct(t.title || t.body), lambda w: 't:' || w) AS tokens,
       list_transform(list_filter(coalesce(e.domains, []), lambda r: r < {TEXT_RULES.label_cap}), lambda r: 'l:' || r) AS labels
FROM c_normal t JOIN c_encoded e ON e."uniqueID" = t."uniqueID\""""
STEPS["c_text_item"] = f"SELECT id, unnest(tokens || labels) AS item FROM c_text_basket WHERE \"set\" = '{TRAINING}'"

# Frequent sets grow by one item a step, each step pruned before the next, until none is left.
_FLOOR = _minimum("c_text_basket", TEXT_RULES)
STEPS["c_single"] = f"""
SELECT id, item FROM c_text_item QUALIFY count(*) OVER (PARTITION BY item) >= {_FLOOR}"""
STEPS["c_grown"] = f"""
SELECT id, [item] AS items, item AS last FROM c_single
UNION ALL
(SELECT id, items, last
FROM (SELECT p.id, list_append(p.items, n.item) AS items, n.item AS last
      FROM c_grown p JOIN c_single n ON n.id = p.id AND n.item > p.last)
QUALIFY count(*) OVER (PARTITION BY items) >= {_FLOOR})"""
STEPS["c_text_itemset"] = "SELECT items, count(*) AS freq FROM c_grown GROUP BY items"
STEPS["c_text_rule"] = _rules_of("c_text_itemset", TEXT_RULES)
STEPS["c_prediction"] = """
SELECT b.id, list(DISTINCT r.consequent ORDER BY r.consequent) AS prediction
FROM c_text_basket b JOIN c_text_rule r ON list_has_all(b.tokens, r.antecedent) AND NOT list_contains(b.tokens, r.consequent)
GROUP BY b.id"""
STEPS["c_predicted"] = """
SELECT b.*, coalesce(p.prediction, []) AS prediction
FROM c_text_basket b LEFT JOIN c_prediction p ON p.id = b.id"""

# Rules that conclude a language: valid sets are not extended, and only the minimal ones stay.
STEPS["c_lang_tag"] = f"""
SELECT doc_id AS "uniqueID", trim(lang) AS tag, {_set('doc_id')} AS "set" FROM documents WHERE trim(lang) <> ''"""
STEPS["c_lang_rank"] = f"""
SELECT tag, row_number() OVER (ORDER BY count(*) DESC, tag) - 1 AS r FROM c_lang_tag WHERE "set" = '{TRAINING}' GROUP BY tag"""
STEPS["c_lang_basket"] = f"""
SELECT t."uniqueID" AS id, t."set", list_transform(list_distinct(t.title || t.body), lambda w: 't:' || w) AS tokens,
       CASE WHEN k.r < {LABEL_RULES.label_cap} THEN ['l:' || k.r] ELSE [] END AS labels
FROM c_normal t JOIN c_lang_tag g ON g."uniqueID" = t."uniqueID" LEFT JOIN c_lang_rank k ON k.tag = g.tag"""
STEPS["c_lang_item"] = f"""
SELECT id, labels, unnest(tokens) AS item FROM c_lang_basket WHERE "set" = '{TRAINING}'"""
STEPS["c_lang_single"] = """
SELECT item, list(id) AS ids, count(*) AS n FROM c_lang_item GROUP BY item"""
STEPS["c_lang_pair"] = f"""
SELECT label, item, list(id) AS own FROM (SELECT id, item, unnest(labels) AS label FROM c_lang_item)
GROUP BY label, item HAVING count(*) >= {LABEL_RULES.support_count}"""
STEPS["c_lang_open"] = f"""
SELECT label, item, own, ids, n FROM c_lang_pair JOIN c_lang_single USING (item)
WHERE len(own)::DOUBLE / n < {LABEL_RULES.min_confidence}"""
STEPS["c_lang_set"] = f"""
SELECT label, [item] AS items, item AS last, own, ids FROM c_lang_pair JOIN c_lang_single USING (item)
UNION ALL
(SELECT label, items, last, own, ids FROM (
  SELECT s.label, list_append(s.items, o.item) AS items, o.item AS last,
         list_intersect(s.own, o.own) AS own, list_intersect(s.ids, o.ids) AS ids
  FROM c_lang_set s JOIN c_lang_open o ON o.label = s.label AND o.item > s.last
  WHERE len(s.own)::DOUBLE / len(s.ids) < {LABEL_RULES.min_confidence}
) WHERE len(own) >= {LABEL_RULES.support_count})"""
STEPS["c_lang_valid"] = f"""
SELECT label, items, len(own)::BIGINT AS freq, len(own)::DOUBLE / len(ids) AS confidence FROM c_lang_set
WHERE len(own)::DOUBLE / len(ids) >= {LABEL_RULES.min_confidence}"""
STEPS["c_lang_rule"] = """
SELECT * FROM c_lang_valid v WHERE len(v.items) = 1 OR NOT EXISTS (
  SELECT 1 FROM c_lang_valid w
  WHERE w.label = v.label AND len(w.items) < len(v.items) AND len(w.items) > 1 AND list_has_all(v.items, w.items))"""
STEPS["c_lang_guess"] = """
SELECT id, list(DISTINCT label) AS guess FROM (
  SELECT t.id, r.label FROM (SELECT id, unnest(tokens) AS item FROM c_lang_basket) t
  JOIN (SELECT label, items[1] AS item FROM c_lang_rule WHERE len(items) = 1) r USING (item)
  UNION ALL
  SELECT t.id, r.label FROM (SELECT id, tokens, unnest(tokens) AS item FROM c_lang_basket) t
  JOIN (SELECT label, items, items[1] AS item FROM c_lang_rule WHERE len(items) > 1) r
    ON r.item = t.item AND list_has_all(t.tokens, r.items)
) GROUP BY id"""
STEPS["c_guessed"] = """
SELECT b.*, coalesce(p.guess, []) AS guess FROM c_lang_basket b LEFT JOIN c_lang_guess p ON p.id = b.id"""
STEPS["c_confusion"] = """
SELECT id, "set", list_filter(guess, lambda x: list_contains(labels, x)) AS tp,
       list_filter(guess, lambda x: NOT list_contains(labels, x)) AS fp,
       list_filter(labels, lambda x: NOT list_contains(guess, x)) AS fn
FROM c_guessed"""


def _sorted_text(values: str) -> str:
    return _text_of(f"list_sort({values})", ",")


ORACLES["baskets"] = f"""
SELECT id, "set", {_sorted_text('tokens')} AS tokens, {_sorted_text('labels')} AS labels,
       {_sorted_text('tokens || labels')} AS items FROM c_text_basket"""
_PREDICT = f'SELECT id, "set", {_sorted_text("prediction")} AS prediction FROM c_predicted'
ORACLES["predict"] = _PREDICT
ORACLES["predict_joined"] = "SELECT id, unnest(prediction) AS item FROM c_predicted"
ORACLES["itemsets"] = f"SELECT {_sorted_text('items')} AS items, freq FROM c_text_itemset"
ORACLES["rules"] = f"""
SELECT {_sorted_text('antecedent')} AS antecedent, consequent, round(confidence, 6) AS confidence FROM c_text_rule"""
ORACLES["label_rules"] = f"""
SELECT {_sorted_text('items')} AS antecedent, label AS consequent, freq, round(confidence, 6) AS confidence FROM c_lang_rule"""
ORACLES["confusion"] = f"""
SELECT id, "set", {_sorted_text('tp')} AS tp, {_sorted_text('fp')} AS fp, {_sorted_text('fn')} AS fn FROM c_confusion"""
STEPS["c_score"] = """
SELECT "set", sum(len(tp))::BIGINT AS tp, sum(len(fp))::BIGINT AS fp, sum(len(fn))::BIGINT AS fn FROM c_confusion GROUP BY "set\""""
STEPS["c_ratio"] = """
SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS p, tp::DOUBLE / nullif(tp + fn, 0) AS q FROM c_score"""
ORACLES["scores"] = """
SELECT "set", tp, fp, fn, round(p, 6) AS precision, round(q, 6) AS recall, round(p * q * 2 / nullif(p + q, 0), 6) AS f1 FROM c_ratio"""

STEPS["c_item"] = """
SELECT "set", "uniqueID", list_distinct(title || body) AS tokens, list_distinct(domains) AS labels FROM c_sample"""
ORACLES["transactions"] = """
SELECT "set", count(*) AS posts, sum(len(tokens))::BIGINT AS tokens, sum(len(labels))::BIGINT AS labels,
       sum(coalesce(list_sum(labels), 0))::BIGINT AS label_sum FROM c_item GROUP BY "set\""""
ORACLES["transaction_lines"] = f"""
SELECT "set", {_text_of('labels')} AS labels, len(tokens)::BIGINT AS tokens
FROM (SELECT "set", tokens, list_sort(labels) AS labels FROM c_item)"""
ORACLES["appearances"] = """
SELECT "set", 'body' AS role, count(DISTINCT token) AS items, 0::BIGINT AS label_sum
FROM (SELECT "set", unnest(tokens) AS token FROM c_item) GROUP BY "set"
UNION ALL
SELECT "set", 'head', count(DISTINCT label), sum(DISTINCT label)::BIGINT
FROM (SELECT "set", unnest(labels) AS label FROM c_item) GROUP BY "set\""""

_NAMES = "list_transform(tokens, lambda t: 't:' || t) || list_transform(labels, lambda r: 'l:' || r)"
ORACLES["transaction_contents"] = f'SELECT "set", {_sorted_text(_NAMES)} AS items FROM c_item'
ORACLES["appearance_contents"] = f"""
SELECT DISTINCT "set", name, CASE WHEN name LIKE 't:%' THEN 'body' ELSE 'head' END AS role
FROM (SELECT "set", unnest({_NAMES}) AS name FROM c_item)"""

# Sources and sinks

ORACLES["csv_post_text"] = 'SELECT "uniqueID", title, body, domain FROM c_text'
ORACLES["csv_post_tags"] = 'SELECT "uniqueID", tags, domain FROM c_tag'
_LOOKUPS = """
SELECT 'dictionary' AS source, '' AS domain, token AS name, i::BIGINT AS number FROM c_dictionary
UNION ALL SELECT 'global_tags', '', tag, r::BIGINT FROM c_global
UNION ALL SELECT 'domain_tags', domain, tag, r::BIGINT FROM c_domain
UNION ALL SELECT 'vocabulary', '', term, r::BIGINT FROM c_vocabulary"""
ORACLES["lookups_parquet"] = _LOOKUPS
ORACLES["lookups_csv"] = _LOOKUPS

# Checks

ORACLES["input_counts"] = """
SELECT 'text' AS input, count(*) AS "rows", count(DISTINCT "uniqueID") AS ids FROM c_text
UNION ALL SELECT 'tags', count(*), count(DISTINCT "uniqueID") FROM c_tag"""
ORACLES["lost_ids"] = 'SELECT count(*) AS lost FROM c_text WHERE "uniqueID" NOT IN (SELECT "uniqueID" FROM c_tag)'
ORACLES["feature_check"] = """
SELECT field, count(*) AS posts, count(*) FILTER (features > CASE field WHEN 'title' THEN len(title) ELSE len(body) END) AS violations
FROM (SELECT "uniqueID", field, count(*) AS features FROM c_field_term JOIN c_vocabulary USING (term) GROUP BY ALL)
JOIN c_token USING ("uniqueID") GROUP BY field"""
ORACLES["multi_label"] = 'SELECT "set", count(*) FILTER (len(domains) > 1) AS "multiLabel" FROM c_sample GROUP BY "set"'

STEPS["c_small_shard"] = _shard("c_sample", SHARD_ROWS)
ORACLES["partition_report"] = """
SELECT domain, "set", rng, 1::BIGINT AS files, count(*) AS "rows", count(*) AS largest FROM c_small_shard GROUP BY domain, "set", rng"""
ORACLES["sample_manifest"] = """
SELECT domain, "set", count(*) AS "rows", min("uniqueID") AS least, max("uniqueID") AS most, count(*) AS read
FROM c_sample GROUP BY domain, "set\""""
ORACLES["post_by_id"] = f'SELECT "uniqueID", title, domain FROM c_text WHERE "uniqueID" = {LOOKED_UP}'
_SAMPLED = _draw('"uniqueID"', Options(seed=SAMPLE_SEED))
ORACLES["post_sample"] = f"""
SELECT "uniqueID", domain FROM c_text WHERE {_SAMPLED}::DOUBLE / 4294967296::DOUBLE < CAST('{SAMPLE_SHARE!r}' AS DOUBLE)"""
ORACLES["default_domain"] = """
SELECT CASE WHEN "uniqueID" % 2 = 0 THEN domain ELSE 'undefined_domain' END AS domain, count(*) AS "rows" FROM c_tag GROUP BY 1"""

ORACLES = {name: _compose(sql.strip()) for name, sql in ORACLES.items()}
