"""Registry of the linkage queries and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import lexicon as lx
from weftlink.functions import similarity as sim
from weftlink.functions import text
from weftlink.operators import blocking, decide, features, metrics, model, neighbours, split, tfidf, validate
from weftlink.plans import kernels, pipeline, surrogate
from weftlink.sources import tables
from weftlink.sources.staging import staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
_R = surrogate.RECORDS
_WITH = f"WITH records AS ({surrogate.RECORDS}), scored AS ({surrogate.SCORED}), truth AS ({surrogate.TRUTH}), keys AS ({surrogate.KEYS})"


def query(sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_SQUEEZE = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_STRIP = "trim(regexp_replace(regexp_replace({}, '\\s*\\|.*$', ''), '[\\[\\]()\\{{\\}}]', ' ', 'g'), '-<>#*~_=+| ')"
_ALIAS = r"(?:\bdba\b|\bd/b/a\b|\btrading as\b)"
_FOREIGN = r"'[^\x00-\x7F]'"
_TOKENS = "list_filter(string_split({}, ' '), lambda t: t <> '')"
_DOMAIN = r"(?i)\b[\w.-]+\.(com|net|org|in|co\.in|fr|io|biz|info)\b"
_NAMES_SQL = f"""names0 AS (
    SELECT entity_id, regexp_matches(f, '{_DOMAIN}') AS is_domain, regexp_replace(f, '(?i)\\b([\\w-]*)[\\w.-]*\\.(?:com|net|org|in|co\\.in|fr|io|biz|info)\\b', '\\1', 'g') AS n
    FROM (SELECT entity_id, replace(replace(strip_accents(business_name), 'ß', 'ss'), '&', ' and ') AS f FROM records)
), names1 AS (
    SELECT entity_id, is_domain, {_SQUEEZE.format(_STRIP.format(f"regexp_extract(n, '(?i)^(.*?)(?:{_ALIAS}.*)?$', 1)"))} AS head, {_SQUEEZE.format(_STRIP.format(f"regexp_extract(n, '(?i){_ALIAS}(.*)$', 1)"))} AS name_alt FROM names0
), names2 AS (
    SELECT *, list_transform(list_filter({_TOKENS.format('head')}, lambda t: NOT list_contains({_list(lx.HONORIFICS)}, t)), lambda t: coalesce({_map(lx.LEGAL_FORMS)}[t], t)) AS w0 FROM names1
), names3 AS (
    SELECT *, list_transform(list_filter(list_zip(w0, list_prepend(NULL, w0)), lambda z: z[1] IS NOT NULL AND z[1] IS DISTINCT FROM z[2]), lambda z: z[1]) AS w FROM names2
), names AS (
    SELECT entity_id, is_domain, name_alt, array_to_string(w, ' ') AS name_norm,
        array_to_string(list_filter(w, lambda t: NOT list_contains({_list(lx.LEGAL_CODES)}, t)), ' ') AS core,
        array_to_string(list_sort(list_distinct(list_filter(w, lambda t: list_contains({_list(lx.LEGAL_CODES)}, t)))), ' ') AS legal_forms,
        coalesce(nullif(list_filter(w, lambda t: NOT list_contains({_list(lx.LEGAL_CODES)}, t))[1], ''), w[1], '') AS first_token
    FROM names3
), named AS (
    SELECT entity_id, is_domain, name_alt, name_norm, CASE WHEN core = '' THEN name_norm ELSE core END AS name_core, legal_forms, first_token FROM names
)"""
_STATES = {"US": lx.US_STATES, "India": lx.INDIA_STATES}
_ABBR = "CASE country " + " ".join(f"WHEN '{c}' THEN coalesce({_map(t)}[t], t)" for c, t in lx.ADDRESS_WORDS.items()) + " ELSE t END"


def _first_state(table: dict[str, str]) -> str:
    rows = [(k, v) for k, v in table.items()] + [(c.lower(), c) for c in sorted(set(table.values()))]
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(a), '\\b{k}\\b') THEN '{v}'" for k, v in rows) + " ELSE '' END"


_LANDMARK = f"'(?i)\\b(?:{'|'.join(lx.LANDMARK_WORDS)})\\b\\.?\\s+([^,]+)'"
_POSTPOSED = r"'(?i)([^,]+?)\s+ke\s+pas\b'"
_ADDR_SQL = f"""addr0 AS (
    SELECT entity_id, country, raw, CASE WHEN regexp_matches(r, {_LANDMARK}) THEN lower(trim(regexp_extract(r, {_LANDMARK}, 1))) WHEN regexp_matches(r, {_POSTPOSED}) THEN lower(trim(regexp_extract(r, {_POSTPOSED}, 1))) ELSE '' END AS landmark,
        CASE WHEN regexp_matches(r, {_LANDMARK}) THEN regexp_replace(r, {_LANDMARK}, ' ') ELSE regexp_replace(r, {_POSTPOSED}, ' ') END AS a
    FROM (SELECT entity_id, country, business_address AS raw, regexp_replace(business_address, '(?i)\\b(?:city|town|village)\\s+of\\s+', '', 'g') AS r FROM records)
), addr1 AS (
    SELECT *, CASE country WHEN 'India' THEN regexp_extract(raw, '(?:^|[^0-9])([1-9][0-9]{{2}}\\s?[0-9]{{3}})(?:[^0-9]|$)', 1) ELSE regexp_extract(raw, '\\b([0-9]{{5}})\\b', 1) END AS pincode,
        CASE country WHEN 'US' THEN {_first_state(lx.US_STATES)} WHEN 'India' THEN {_first_state(lx.INDIA_STATES)}
            ELSE CASE {" ".join(f"WHEN contains(lower(a), '{k.replace(chr(39), chr(39) * 2)}') THEN '{v}'" for k, v in lx.FRANCE_REGIONS.items())} ELSE '' END END AS state_code,
        {_TOKENS.format(_SQUEEZE.format('a'))} AS t0 FROM addr0
), addr2 AS (
    SELECT *, list_transform(list_transform(list_transform(list_transform(t0, lambda t: coalesce({_map(lx.ORDINALS)}[t], t)), lambda t: {_ABBR}), lambda t: coalesce({_map(lx.CITIES)}[t], t)),
        lambda t: CASE WHEN regexp_full_match(t, '0[0-9]+') THEN CAST(CAST(t AS BIGINT) AS VARCHAR) ELSE t END) AS t FROM addr1
), addressed AS (
    SELECT entity_id, pincode, state_code, landmark, array_to_string(t, ' ') AS addr_norm, array_to_string(list_filter(t, lambda x: NOT regexp_full_match(x, '[0-9]+')), ' ') AS addr_core,
        array_to_string(list_sort(list_distinct(list_filter(t, lambda x: regexp_full_match(x, '[0-9]+')))), ' ') AS numeric_tokens,
        coalesce(list_filter(t, lambda x: regexp_full_match(x, '[0-9]+'))[1], '') AS house_number,
        coalesce(list_filter({_list(lx.CITIES.values())}, lambda c: list_contains(t, c))[1], '') AS city FROM addr2
)"""
_NORMAL = f"{_WITH}, {_NAMES_SQL}, {_ADDR_SQL}, normal AS (SELECT r.entity_id, r.source, r.country, r.k, r.business_name, r.business_address, n.* EXCLUDE (entity_id), a.* EXCLUDE (entity_id) FROM records r JOIN named n USING (entity_id) JOIN addressed a USING (entity_id))"


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(text.normalize(surrogate.records(spark, sf_dir)), "normal")


# Scalar normalization ---------------------------------------------------------------------------


@query(f"{_WITH}, {_NAMES_SQL} SELECT * EXCLUDE (first_token) FROM named")
def name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.with_names(surrogate.records(spark, sf_dir))
    return rows.select("entity_id", "is_domain", "name_alt", "name_norm", "name_core", F.array_join("legal_forms", " ").alias("legal_forms"))


@query(f"{_WITH}, {_ADDR_SQL} SELECT * EXCLUDE (city) FROM addressed")
def address_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.with_addresses(surrogate.records(spark, sf_dir))
    return rows.select("entity_id", "pincode", "state_code", "landmark", "addr_norm", "addr_core", F.array_join("numeric_tokens", " ").alias("numeric_tokens"), "house_number")


@query(f"{_WITH}, {_NAMES_SQL} SELECT entity_id, name_core AS sn_key_a, array_to_string(list_sort(string_split(name_core, ' ')), ' ') AS sn_key_b FROM named")
def sort_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir).select("entity_id", "sn_key_a", "sn_key_b")


@query("SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS folded FROM documents")
def unicode_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.folded(F.col("text")).alias("folded"))


@query(f"{_WITH}, {_NAMES_SQL} SELECT entity_id, first_token, {kernels.sound_key('first_token')} AS metaphone_key FROM named")
def sound_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_names(surrogate.records(spark, sf_dir)).select("entity_id", "first_token", "metaphone_key")


_NATIVE_SQL = f"""native0 AS (SELECT entity_id, business_name, regexp_replace(replace(business_name, '&', ' and '), '(?i)\\b([\\w-]*)[\\w.-]*\\.(?:com|net|org|in|co\\.in|fr|io|biz|info)\\b', '\\1', 'g') AS n FROM records),
native AS (SELECT entity_id, CASE WHEN regexp_matches(business_name, {_FOREIGN}) THEN trim(regexp_replace(regexp_replace(lower({_STRIP.format(f"regexp_extract(n, '(?i)^(.*?)(?:{_ALIAS}.*)?$', 1)")}), '[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) ELSE '' END AS native_name FROM native0)"""


@query(f"""{_NORMAL}, {_NATIVE_SQL} SELECT entity_id, trim(name_core || ' | ' || addr_core) AS embed_text, CASE WHEN native_name = '' THEN '' ELSE trim(native_name || ' | ' || addr_core) END AS embed_text_native, native_name, '' AS native_addr, city
FROM normal JOIN native USING (entity_id)""")
def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir).select("entity_id", "embed_text", "embed_text_native", "native_name", "native_addr", "city")


# Splits and samples -----------------------------------------------------------------------------


def _fraction_sql(key: str, seed: int) -> str:
    return f"(('0x' || md5('{seed}:' || {key})[:8])::BIGINT / 4294967295.0::DOUBLE)"


@query(f"""{_WITH}, f AS (SELECT s1_entity_id, {_fraction_sql('s1_entity_id', 42)} AS f FROM keys), r AS (SELECT *, CASE WHEN f < 0.2 THEN 0 ELSE row_number() OVER (PARTITION BY f < 0.2 ORDER BY f, s1_entity_id) END AS n FROM f)
SELECT s1_entity_id, CASE WHEN f < 0.15 THEN 'val' WHEN f < 0.2 THEN 'calib' WHEN n <= 1000 THEN 'train' ELSE 'train_unused' END AS pool FROM r""")
def hash_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign_pools(surrogate.keys(spark, sf_dir), most_train=1000)


@query(f"""{_WITH}, c AS (SELECT s1_entity_id FROM keys WHERE {_fraction_sql('s1_entity_id', 42)} < 0.05)
SELECT entity_id FROM (SELECT cand_entity_id AS entity_id FROM truth WHERE s1_entity_id IN (SELECT s1_entity_id FROM c) UNION SELECT entity_id FROM records WHERE source <> 'S1' AND {_fraction_sql('entity_id', 42)} < 0.05)""")
def subset_with_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = surrogate.records(spark, sf_dir).where("source <> 'S1'")
    return split.sample_with_matches(surrogate.keys(spark, sf_dir), surrogate.truth(spark, sf_dir), rows, 0.05)[1]


# Candidate generation ---------------------------------------------------------------------------

_JACCARD = """CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"""


def _words_sql(column: str) -> str:
    return f"list_distinct(list_filter(string_split({column}, ' '), lambda t: t <> ''))"


def _bucket_sql(name: str, key: str, where: str, compare: str, seed: int) -> str:
    return f"""{name}0 AS (SELECT *, {key} AS key, {compare} AS compared FROM normal WHERE {where}),
{name}1 AS (SELECT *, row_number() OVER (PARTITION BY country, source, key ORDER BY md5('{seed}:' || entity_id), entity_id) AS n FROM {name}0 WHERE source <> 'S1'),
{name}2 AS (SELECT *, count(*) OVER (PARTITION BY country, source, key) AS size FROM {name}1 WHERE n <= 500),
{name}3 AS (SELECT s.entity_id AS s1_entity_id, c.entity_id AS cand_entity_id, c.source, c.country, c.size, s.compared AS a, c.compared AS b FROM {name}0 s JOIN {name}2 c ON s.source = 'S1' AND s.country = c.country AND s.key = c.key),
{name}4 AS (SELECT * FROM {name}3 WHERE size > 10), {kernels.ctes(name + "_kernels", name + "4", only_token_set=True)},
{name} AS (SELECT s1_entity_id, cand_entity_id, source, country FROM {name}3 WHERE size <= 10 UNION ALL
    SELECT s1_entity_id, cand_entity_id, source, country FROM (SELECT *, row_number() OVER (PARTITION BY s1_entity_id, source ORDER BY token_set DESC, cand_entity_id) AS r FROM {name}4 JOIN {name}_kernels USING (a, b)) WHERE r <= 10)"""


_HOUSE_SQL = _bucket_sql("house", "state_code || '|' || house_number", "house_number <> ''", "addr_norm", 1)
_SOUND_SQL = _bucket_sql("sound", f"state_code || '|' || {kernels.sound_key('first_token')}", "true", "name_core", 0)


@query(f"{_NORMAL}, {_HOUSE_SQL} SELECT *, true AS from_housenum FROM house")
def house_number_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.house_number(_normal(spark, sf_dir))


@query(f"{_NORMAL}, {_SOUND_SQL} SELECT *, true AS from_phonetic FROM sound")
def phonetic_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.phonetic(_normal(spark, sf_dir))


def _neighbour_sql(key: str, name: str) -> str:
    return f"""{name}0 AS (
    SELECT n.entity_id, country, g.grp, {key} AS key, 0 AS cand FROM normal n, (VALUES ('S2'), ('S3')) g(grp) WHERE source = 'S1'
    UNION ALL SELECT entity_id, country, source, {key}, 1 FROM normal WHERE source <> 'S1'
), {name}1 AS (SELECT *, row_number() OVER (PARTITION BY country, grp ORDER BY key, cand, entity_id) AS p FROM {name}0),
{name} AS (SELECT a.entity_id AS s1_entity_id, b.entity_id AS cand_entity_id, b.grp AS source, b.country FROM {name}1 a JOIN {name}1 b ON a.country = b.country AND a.grp = b.grp AND a.cand = 0 AND b.cand = 1 AND b.p BETWEEN a.p - 5 AND a.p + 5)"""


_SORTED_KEY = "array_to_string(list_sort(string_split(name_core, ' ')), ' ')"


@query(f"{_NORMAL}, {_neighbour_sql(_SORTED_KEY, 'sn')} SELECT *, true AS from_sn FROM sn")
def sorted_neighbourhood_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.sorted_neighbourhood(_normal(spark, sf_dir), "sn_key_b")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("label").alias("grp"), F.col("embedding").alias("vec"))


def _knn_sql(queries: str, base: str, k: int, group: str = "q.label = b.label") -> str:
    return f"""WITH p AS (SELECT q.vec_id AS query_id, b.vec_id AS base_id, list_inner_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM embeddings q JOIN embeddings b ON {group} AND {queries} AND {base}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, base_id) - 1 AS rank FROM p) SELECT query_id, base_id, round(sim, 4) AS sim, rank::INT AS rank FROM r WHERE rank < {k}"""


@query(_knn_sql("q.vec_id % 3 = 0", "b.vec_id % 3 <> 0", 20))
def knn_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return neighbours.exact(v.where("id % 3 = 0"), v.where("id % 3 <> 0"), 20).withColumn("sim", F.round("sim", 4))


@query(_knn_sql("q.vec_id % 3 <> 0", "b.vec_id % 3 = 0", 3))
def knn_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return neighbours.exact(v.where("id % 3 <> 0"), v.where("id % 3 = 0"), 3).withColumn("sim", F.round("sim", 4))


@query(_knn_sql("q.vec_id % 3 = 0", "b.vec_id % 3 <> 0", 20, "true"))
def knn_inverted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return neighbours.inverted(v.where("id % 3 = 0").withColumn("grp", F.lit(0)), v.where("id % 3 <> 0").withColumn("grp", F.lit(0)), 20).withColumn("sim", F.round("sim", 4))


@query()
def nearest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.nearest(neighbours.hashed_embedding(_normal(spark, sf_dir), "embed_text"))


@query(f"""{_NORMAL}, {_HOUSE_SQL}, {_neighbour_sql('name_core', 'sa')}, {_neighbour_sql(_SORTED_KEY, 'sb')}, u AS (
    SELECT *, false AS from_sn, true AS from_housenum FROM house UNION ALL SELECT *, true, false FROM sa UNION ALL SELECT *, true, false FROM sb
) SELECT s1_entity_id, cand_entity_id, source, country, false AS from_ann, false AS from_phonetic, bool_or(from_sn) AS from_sn, bool_or(from_housenum) AS from_housenum, NULL::DOUBLE AS ann_sim, -1 AS ann_rank FROM u GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY s1_entity_id, cand_entity_id, source, country"))
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir)
    return blocking.union_candidates([blocking.house_number(rows), blocking.sorted_neighbourhood(rows, "sn_key_a"), blocking.sorted_neighbourhood(rows, "sn_key_b")])


@query(f"""{_WITH}, u AS (SELECT s1_entity_id, cand_entity_id, source, country, from_ann, false AS from_phonetic, ann_sim, ann_rank FROM scored WHERE from_ann UNION ALL SELECT s1_entity_id, cand_entity_id, source, country, false, true, NULL, -1 FROM scored WHERE from_phonetic)
SELECT s1_entity_id, cand_entity_id, source, country, bool_or(from_ann) AS from_ann, bool_or(from_phonetic) AS from_phonetic, false AS from_sn, false AS from_housenum, max(ann_sim) AS ann_sim, min(ann_rank) AS ann_rank FROM u GROUP BY 1, 2, 3, 4""")
def union_ann_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = surrogate.scored(spark, sf_dir)
    ann = rows.where("from_ann").select(*blocking.PAIR, "from_ann", "ann_sim", "ann_rank")
    return blocking.union_candidates([ann, rows.where("from_phonetic").select(*blocking.PAIR, "from_phonetic")])


# TF-IDF -----------------------------------------------------------------------------------------

_GRAMS_SQL = """list_concat(flatten(list_transform(list_filter(string_split(lower({t}), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, greatest(len(w) + 1, 1)), lambda i: substr(' ' || w || ' ', i, 3)))),
    flatten(list_transform(list_filter(string_split(lower({t}), ' '), lambda w: len(w) >= 2), lambda w: list_transform(range(1, len(w)), lambda i: substr(' ' || w || ' ', i, 4)))))"""
_IDF_SQL = f"""g AS (SELECT entity_id, unnest({_GRAMS_SQL.format(t='name_core')}) AS gram FROM named), tf AS (SELECT entity_id, gram, count(*) AS tf FROM g GROUP BY 1, 2),
idf AS (SELECT gram, count(*) AS df, ln((1 + (SELECT count(*) FROM named)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY 1)"""


@query(f"{_WITH}, {_NAMES_SQL}, {_IDF_SQL} SELECT gram, df, round(idf, 6) AS idf FROM idf")
def tfidf_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.fit_idf(text.with_names(surrogate.records(spark, sf_dir)), "name_core").withColumn("idf", F.round("idf", 6))


@query(f"""{_WITH}, {_NAMES_SQL}, {_IDF_SQL}, raw AS (SELECT entity_id, gram, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (gram)),
w AS (SELECT entity_id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)) AS w FROM raw),
d AS (SELECT s1_entity_id, cand_entity_id, sum(a.w * b.w) AS s FROM scored JOIN w a ON a.entity_id = s1_entity_id JOIN w b ON b.entity_id = cand_entity_id AND a.gram = b.gram GROUP BY 1, 2)
SELECT s1_entity_id, cand_entity_id, round(coalesce(s, 0), 4) AS tfidf_sim FROM scored LEFT JOIN d USING (s1_entity_id, cand_entity_id)""")
def tfidf_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = staged(text.with_names(surrogate.records(spark, sf_dir)).select("entity_id", "name_core"), "named")
    weights = staged(tfidf.weights(named, "entity_id", "name_core", tfidf.fit_idf(named, "name_core")), "weights")
    pairs = surrogate.scored(spark, sf_dir).select("s1_entity_id", "cand_entity_id")
    return tfidf.pair_cosine(pairs, weights, weights).withColumn("tfidf_sim", F.round("tfidf_sim", 4))


# Ranking ----------------------------------------------------------------------------------------


@query(f"{_WITH} SELECT s1_entity_id, cand_entity_id, tfidf_sim FROM scored QUALIFY row_number() OVER (PARTITION BY s1_entity_id ORDER BY tfidf_sim DESC, cand_entity_id) <= 3")
def top_k_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.truncate(surrogate.scored(spark, sf_dir).select("s1_entity_id", "cand_entity_id", "tfidf_sim"), 3)


@query(f"""{_WITH}, v AS (SELECT *, tfidf_sim + ann_sim AS v FROM scored)
SELECT s1_entity_id, cand_entity_id, count(*) OVER c AS n_competitors, (row_number() OVER (PARTITION BY source, cand_entity_id ORDER BY v DESC, s1_entity_id))::INT AS rank_for_cand, round(max(v) OVER c - v, 6) AS gap_to_best_for_cand,
    (row_number() OVER (PARTITION BY s1_entity_id ORDER BY v DESC, source, cand_entity_id))::INT AS rank_for_s1, round(max(v) OVER s - v, 6) AS gap_to_best_for_s1 FROM v WINDOW c AS (PARTITION BY source, cand_entity_id), s AS (PARTITION BY s1_entity_id)""")
def competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocking.with_competition(surrogate.scored(spark, sf_dir))
    return rows.select("s1_entity_id", "cand_entity_id", "n_competitors", "rank_for_cand", F.round("gap_to_best_for_cand", 6).alias("gap_to_best_for_cand"), "rank_for_s1", F.round("gap_to_best_for_s1", 6).alias("gap_to_best_for_s1"))


@query(f"""{_WITH}, r AS (SELECT s1_entity_id, cand_entity_id, t.cand_entity_id IS NOT NULL AS is_true, row_number() OVER (PARTITION BY s.s1_entity_id ORDER BY tfidf_sim + ann_sim DESC, source, s.cand_entity_id) AS rank_for_s1 FROM scored s LEFT JOIN truth t USING (s1_entity_id, cand_entity_id)),
n AS (SELECT *, row_number() OVER (PARTITION BY s1_entity_id, is_true ORDER BY rank_for_s1, cand_entity_id) AS n FROM r) SELECT s1_entity_id, cand_entity_id, is_true::INT AS label FROM n WHERE is_true OR n <= 2""".replace("t.cand_entity_id IS NOT NULL AS is_true", "t.hit IS NOT NULL AS is_true").replace("LEFT JOIN truth t USING", "LEFT JOIN (SELECT *, 1 AS hit FROM truth) t USING").replace("s.s1_entity_id", "s1_entity_id").replace("s.cand_entity_id", "cand_entity_id"))
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.label(blocking.with_competition(surrogate.scored(spark, sf_dir)), surrogate.truth(spark, sf_dir))
    return model.hard_negatives(rows, 2).select("s1_entity_id", "cand_entity_id", "label")


# Pair features ----------------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    rows = _normal(spark, sf_dir).select("entity_id", *columns)
    left = rows.select(F.col("entity_id").alias("s1_entity_id"), *(F.col(c).alias(f"a_{c}") for c in columns))
    right = rows.select(F.col("entity_id").alias("cand_entity_id"), *(F.col(c).alias(f"b_{c}") for c in columns))
    return surrogate.scored(spark, sf_dir).select("s1_entity_id", "cand_entity_id").join(left, "s1_entity_id").join(right, "cand_entity_id")


_PAIRED = "FROM scored s JOIN normal a ON a.entity_id = s.s1_entity_id JOIN normal b ON b.entity_id = s.cand_entity_id"


def _sets(name: str, sql: str) -> str:
    return f"{_JACCARD.format(a=_words_sql('a.' + sql), b=_words_sql('b.' + sql))} AS {name}"


def _flag_sql(column: str, name: str) -> str:
    return f"CASE WHEN a.{column} = '' OR b.{column} = '' THEN -1 ELSE (a.{column} = b.{column})::INT END AS {name}"


@query(f"""{_NORMAL} SELECT s1_entity_id, cand_entity_id, {_sets('name_jaccard', 'name_core')}, {_sets('addr_jaccard', 'addr_core')}, {_sets('numeric_jaccard', 'numeric_tokens')}, {_flag_sql('house_number', 'house_number_match')}, {_flag_sql('pincode', 'pincode_match')}, {_flag_sql('state_code', 'state_match')},
    CASE WHEN a.legal_forms <> '' AND b.legal_forms <> '' AND a.legal_forms = b.legal_forms THEN 1 ELSE 0 END AS legal_match, CASE WHEN a.legal_forms <> '' AND b.legal_forms <> '' AND a.legal_forms <> b.legal_forms THEN 1 ELSE 0 END AS legal_conflict, (a.legal_forms = '' OR b.legal_forms = '')::INT AS legal_missing,
    CASE WHEN a.landmark = '' AND b.landmark = '' THEN -1.0 ELSE {_JACCARD.format(a=_words_sql('a.landmark'), b=_words_sql('b.landmark'))} END AS landmark_overlap,
    CASE WHEN greatest(length(a.name_core), length(b.name_core)) = 0 THEN 0.0 ELSE least(length(a.name_core), length(b.name_core))::DOUBLE / greatest(length(a.name_core), length(b.name_core)) END AS name_len_ratio {_PAIRED}""")
def pair_set_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir, ["name_core", "addr_core", "numeric_tokens", "house_number", "pincode", "state_code", "legal_forms", "landmark"])
    c = F.col
    match, conflict, missing = sim.legal_flags(c("a_legal_forms"), c("b_legal_forms"))
    words = lambda name: sim.jaccard(sim.words(c(f"a_{name}")), sim.words(c(f"b_{name}")))
    return rows.select(
        "s1_entity_id", "cand_entity_id", words("name_core").alias("name_jaccard"), words("addr_core").alias("addr_jaccard"),
        sim.jaccard(c("a_numeric_tokens"), c("b_numeric_tokens")).alias("numeric_jaccard"),
        *(sim.tri_state(c(f"a_{f}"), c(f"b_{f}")).alias(n) for f, n in (("house_number", "house_number_match"), ("pincode", "pincode_match"), ("state_code", "state_match"))),
        match.alias("legal_match"), conflict.alias("legal_conflict"), missing.alias("legal_missing"),
        F.when((c("a_landmark") == "") & (c("b_landmark") == ""), -1.0).otherwise(words("landmark")).alias("landmark_overlap"),
        sim.length_ratio(c("a_name_core"), c("b_name_core")).alias("name_len_ratio"),
    )


@query(f"{_NORMAL} SELECT s1_entity_id, cand_entity_id, round(jaro_winkler_similarity(a.name_core, b.name_core), 4) AS name_jarowinkler {_PAIRED}")
def name_jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir, ["name_core"])
    return rows.select("s1_entity_id", "cand_entity_id", F.round(sim.kernels_udf("a_name_core", "b_name_core")["jaro_winkler"], 4).alias("name_jarowinkler"))


@query(f"""{_NORMAL}, p AS (SELECT s1_entity_id, cand_entity_id, a.name_core AS a, b.name_core AS b {_PAIRED}), {kernels.ctes("k", "p")}
SELECT s1_entity_id, cand_entity_id, {", ".join(f"round({c}, 6) AS {c}" for c in sim.KERNELS)} FROM p JOIN k USING (a, b)""")
def string_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir, ["name_core"]).withColumn("k", sim.kernels_udf("a_name_core", "b_name_core"))
    return rows.select("s1_entity_id", "cand_entity_id", *(F.round(f"k.{c}", 6).alias(c) for c in sim.KERNELS))


def _feature_sql() -> str:
    """The features of every scored pair, each by its own expression."""
    both = lambda name: f"{_JACCARD.format(a=_words_sql('a.' + name), b=_words_sql('b.' + name))}"
    size = lambda c: f"CASE WHEN greatest(length(a.{c}), length(b.{c})) = 0 THEN 0.0 ELSE least(length(a.{c}), length(b.{c}))::DOUBLE / greatest(length(a.{c}), length(b.{c})) END"
    foreign = lambda c: f"regexp_matches({c}.business_name, '[^\\x00-\\x7F]')"
    legal = lambda test: f"(a.legal_forms <> '' AND b.legal_forms <> '' AND a.legal_forms {test} b.legal_forms)::INT"
    made = {
        "name_lev": "kn.ratio", "name_jarowinkler": "kn.jaro_winkler", "name_token_set": "kn.token_set", "name_token_sort": "kn.token_sort", "name_partial": "kn.partial",
        "name_exact_core": "(a.name_core = b.name_core)::INT", "name_exact_norm": "(a.name_norm = b.name_norm)::INT",
        "name_first_token_match": "(string_split(a.name_core, ' ')[1] = string_split(b.name_core, ' ')[1])::INT", "name_token_jaccard": both("name_core"),
        "legal_form_match": legal("="), "legal_form_conflict": legal("<>"), "legal_form_missing": "(a.legal_forms = '' OR b.legal_forms = '')::INT",
        "either_is_domain": "(a.is_domain OR b.is_domain)::INT", "either_translit": f"({foreign('a')} OR {foreign('b')})::INT", "name_len_ratio": size("name_core"),
        "name_alt_token_set": "greatest(kn.token_set, ko.token_set)", "addr_lev": "ka.ratio", "addr_token_set": "ka.token_set",
        "addr_token_jaccard": both("addr_core"), "addr_numeric_jaccard": both("numeric_tokens"),
        "landmark_overlap": f"CASE WHEN a.landmark = '' AND b.landmark = '' THEN -1.0 ELSE {both('landmark')} END",
        "addr_empty_a": "(coalesce(a.business_address, '') = '')::INT", "addr_empty_b": "(coalesce(b.business_address, '') = '')::INT", "addr_len_ratio": size("addr_core"),
        "country_match": "(a.country IS NOT DISTINCT FROM b.country)::INT", "source_is_s2": "(p.source = 'S2')::INT", "ann_sim": "coalesce(p.ann_sim, -1.0)", "ann_rank": "coalesce(p.ann_rank, -1)",
        "tfidf_sim": "coalesce(p.tfidf_sim, 0.0)", "n_competitors": "count(*) OVER c", "rank_for_cand": "(row_number() OVER (c ORDER BY p.v DESC, s1_entity_id))::INT", "gap_to_best_for_cand": "max(p.v) OVER c - p.v",
        "rank_for_s1": "(row_number() OVER (o ORDER BY p.v DESC, p.source, cand_entity_id))::INT", "gap_to_best_for_s1": "max(p.v) OVER o - p.v",
    }
    columns = [f"{e} AS {n}" for n, e in made.items()] + [f"p.{f}::INT AS {f}" for f in blocking.FLAGS] + [_flag_sql(c, n) for c, n in (("house_number", "house_number_match"), ("pincode", "pincode_match"), ("state_code", "state_match"))]
    texts = "SELECT a.{0} AS a, b.{0} AS b " + _PAIRED + " UNION SELECT CASE WHEN a.name_alt <> '' THEN a.name_alt ELSE a.name_core END, CASE WHEN b.name_alt <> '' THEN b.name_alt ELSE b.name_core END " + _PAIRED + " UNION SELECT a.addr_norm, b.addr_norm " + _PAIRED
    other = "CASE WHEN {0}.name_alt <> '' THEN {0}.name_alt ELSE {0}.name_core END"
    double = [n for n in features.FEATURES if n in made and "::INT" not in made[n] and n not in ("n_competitors", "ann_rank")]
    return f"""{_NORMAL}, t AS ({texts.format("name_core")}), {kernels.ctes("k", "t")}, made AS (
    SELECT s1_entity_id, cand_entity_id, p.source, p.country, p.calib_proba, {", ".join(columns)} FROM (SELECT *, tfidf_sim + coalesce(ann_sim, 0) AS v FROM scored) p
    JOIN normal a ON a.entity_id = s1_entity_id JOIN normal b ON b.entity_id = cand_entity_id JOIN k kn ON kn.a = a.name_core AND kn.b = b.name_core
    JOIN k ka ON ka.a = a.addr_norm AND ka.b = b.addr_norm JOIN k ko ON ko.a = {other.format("a")} AND ko.b = {other.format("b")}
    WINDOW c AS (PARTITION BY p.source, cand_entity_id), o AS (PARTITION BY s1_entity_id))
SELECT * REPLACE ({", ".join(f"round({n}, 6) AS {n}" for n in double)}),
    round(0.4 * name_token_set + 0.35 * addr_token_set + 0.15 * greatest(house_number_match, 0) + 0.1 * country_match, 6) AS baseline_score FROM made"""


@query(_feature_sql())
def all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.baseline_score(features.compute(blocking.with_competition(surrogate.scored(spark, sf_dir)), _normal(spark, sf_dir)))
    double = {f.name for f in rows.schema if f.dataType.typeName() == "double"}
    return rows.select(*(F.round(c, 6).alias(c) if c in double and c != "calib_proba" else F.col(c) for c in rows.columns))


@query(f"""{_NORMAL} SELECT s1_entity_id, cand_entity_id, round(0.4 * ({_JACCARD.format(a=_words_sql('a.name_core'), b=_words_sql('b.name_core'))}) + 0.35 * ({_JACCARD.format(a=_words_sql('a.addr_norm'), b=_words_sql('b.addr_norm'))})
    + 0.15 * CASE WHEN a.house_number <> '' AND a.house_number = b.house_number THEN 1 ELSE 0 END + 0.1, 6) AS baseline_score {_PAIRED}""")
def baseline_by_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir, ["name_core", "addr_norm", "house_number"])
    words = lambda name: sim.jaccard(sim.words(F.col(f"a_{name}")), sim.words(F.col(f"b_{name}")))
    rows = rows.select("s1_entity_id", "cand_entity_id", words("name_core").alias("name_token_set"), words("addr_norm").alias("addr_token_set"), sim.tri_state(F.col("a_house_number"), F.col("b_house_number")).alias("house_number_match"), F.lit(1).alias("country_match"))
    return features.baseline_score(rows).select("s1_entity_id", "cand_entity_id", F.round("baseline_score", 6).alias("baseline_score"))


# Decisions and measures -------------------------------------------------------------------------

_OWNED = "owned AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY source, cand_entity_id ORDER BY calib_proba DESC, ann_sim DESC, tfidf_sim DESC, s1_entity_id) = 1)"


def _counts_sql(predicted: str, keys: str = "keys", name: str = "counts", by: str = "") -> str:
    return f"""{name} AS (SELECT k.s1_entity_id, count(DISTINCT p.cand_entity_id) AS n_pred, count(DISTINCT t.cand_entity_id) AS n_true, count(DISTINCT CASE WHEN p.cand_entity_id = t.cand_entity_id THEN p.cand_entity_id END) AS tp
    FROM {keys} k LEFT JOIN ({predicted}) p USING (s1_entity_id) LEFT JOIN truth t USING (s1_entity_id) GROUP BY 1)"""


_F05 = "CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END"
_SUMMARY = f"""round(avg({_F05}), 6) AS f05, round(CASE WHEN sum(n_pred) = 0 THEN 1.0 ELSE sum(tp) / sum(n_pred) END, 6) AS precision_micro, round(CASE WHEN sum(n_true) = 0 THEN 1.0 ELSE sum(tp) / sum(n_true) END, 6) AS recall_micro,
    round(avg(CASE WHEN n_pred = 0 THEN (n_true = 0)::INT::DOUBLE ELSE tp / n_pred END), 6) AS precision_macro, round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE tp / n_true END), 6) AS recall_macro"""


def _rounded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c not in keep and t == "double" else F.col(c) for c, t in df.dtypes))


def _owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.one_owner(surrogate.scored(spark, sf_dir))


@query(f"{_WITH}, {_OWNED} SELECT s1_entity_id, cand_entity_id, source, calib_proba FROM owned")
def one_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owned(spark, sf_dir).select("s1_entity_id", "cand_entity_id", "source", "calib_proba")


@query(f"""{_WITH}, {_OWNED}, grid AS (SELECT i / 200.0::DOUBLE AS threshold FROM range(10, 199) r(i)), tn AS (SELECT s1_entity_id, count(*) AS n_true FROM truth GROUP BY 1),
m AS (SELECT o.s1_entity_id, calib_proba, t.cand_entity_id IS NOT NULL AS hit FROM owned o LEFT JOIN truth t ON t.s1_entity_id = o.s1_entity_id AND t.cand_entity_id = o.cand_entity_id),
c AS (SELECT threshold, k.s1_entity_id, coalesce(any_value(n_true), 0) AS n_true, count(CASE WHEN calib_proba >= threshold THEN 1 END) AS n_pred, count(CASE WHEN hit AND calib_proba >= threshold THEN 1 END) AS tp FROM grid CROSS JOIN keys k LEFT JOIN tn USING (s1_entity_id) LEFT JOIN m USING (s1_entity_id) GROUP BY 1, 2)
SELECT round(threshold, 6) AS threshold, round(avg({_F05}), 6) AS f05 FROM c GROUP BY 1""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(decide.threshold_sweep(_owned(spark, sf_dir), surrogate.keys(spark, sf_dir), surrogate.truth(spark, sf_dir)))


@query(f"""{_WITH}, {_OWNED}, r AS (SELECT *, row_number() OVER w AS m, sum(calib_proba) OVER (PARTITION BY s1_entity_id ORDER BY calib_proba DESC, cand_entity_id ROWS UNBOUNDED PRECEDING) AS cum, sum(calib_proba) OVER e AS alls, list_product(list(1 - calib_proba) OVER e) AS none FROM owned WHERE calib_proba >= 0.02
    WINDOW w AS (PARTITION BY s1_entity_id ORDER BY calib_proba DESC, cand_entity_id), e AS (PARTITION BY s1_entity_id)),
f AS (SELECT *, round(1.25 * (cum / m) * (cum / alls) / (0.25 * (cum / m) + cum / alls), 12) AS f FROM r), b AS (SELECT s1_entity_id, max(f) AS best, arg_min(m, (-f, m)) AS keep FROM f GROUP BY 1)
SELECT s1_entity_id, cand_entity_id FROM f JOIN b USING (s1_entity_id) WHERE best > none AND m <= keep""")
def expected_f05_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.expected_f05(_owned(spark, sf_dir))


@query(f"{_WITH}, {_OWNED}, {_counts_sql('SELECT * FROM owned WHERE calib_proba >= 0.5')} SELECT {_SUMMARY} FROM counts")
def entity_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.evaluate(surrogate.keys(spark, sf_dir), decide.at_threshold(_owned(spark, sf_dir), 0.5), surrogate.truth(spark, sf_dir)))


@query()
def cross_fit_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned, keys, truth = staged(_owned(spark, sf_dir), "owned"), surrogate.keys(spark, sf_dir), surrogate.truth(spark, sf_dir)
    chosen = decide.choose(owned, keys, truth)
    return spark.createDataFrame([(decide.cross_fit(owned, keys, truth), chosen["mode"], float(chosen["f05"]))], "cross_fit_f05 double, mode string, f05 double")


def _sweep_sql() -> str:
    labels = [(f"k={k}", f"r <= {k}") for k in (5, 10, 15, 20, 25, 30, 40, 50)] + [("full_union", "true")] + [(f, f) for f in blocking.FLAGS]
    return " UNION ALL ".join(f"SELECT '{name}' AS label, s1_entity_id, cand_entity_id FROM ranked WHERE {test}" for name, test in labels)


@query(f"""{_WITH}, ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_entity_id ORDER BY tfidf_sim DESC, cand_entity_id) AS r FROM scored), l AS ({_sweep_sql()}), names AS (SELECT DISTINCT label FROM l),
per AS (SELECT label, l.s1_entity_id, count(*) AS n, count(t.cand_entity_id) AS tp FROM l LEFT JOIN truth t ON t.s1_entity_id = l.s1_entity_id AND t.cand_entity_id = l.cand_entity_id GROUP BY 1, 2),
tn AS (SELECT k.s1_entity_id, count(t.cand_entity_id) AS n_true FROM keys k LEFT JOIN truth t USING (s1_entity_id) GROUP BY 1),
g AS (SELECT names.label, tn.s1_entity_id, n_true, n, coalesce(tp, 0) AS tp FROM names CROSS JOIN tn LEFT JOIN per ON per.label = names.label AND per.s1_entity_id = tn.s1_entity_id)
SELECT label, round(sum(tp) / sum(n_true), 6) AS recall, round(avg(CASE WHEN n_true = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_true) / (0.25 + tp / n_true) END), 6) AS ceiling_f05, round(avg(n), 6) AS mean_candidates, sum(n)::BIGINT AS total_pairs FROM g GROUP BY 1""")
def recall_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(blocking.recall_sweep(surrogate.scored(spark, sf_dir), surrogate.keys(spark, sf_dir), surrogate.truth(spark, sf_dir)))


@query(f"""{_WITH}, c AS (SELECT k.s1_entity_id, count(s.cand_entity_id) AS n FROM keys k LEFT JOIN (SELECT * FROM scored WHERE from_phonetic) s USING (s1_entity_id) GROUP BY 1)
SELECT round(avg(n), 6) AS mean, quantile_cont(n, 0.5)::DOUBLE AS median, round(quantile_cont(n, 0.95)::DOUBLE, 6) AS p95, max(n) AS most, count(CASE WHEN n = 0 THEN 1 END) AS without FROM c""")
def candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(blocking.candidate_stats(surrogate.keys(spark, sf_dir), surrogate.scored(spark, sf_dir).where("from_phonetic")))


@query(f"{_WITH}, {_OWNED}, c AS (SELECT country, k.s1_entity_id, count(o.cand_entity_id) > 0 AS has FROM keys k LEFT JOIN (SELECT * FROM owned WHERE calib_proba >= 0.7) o USING (s1_entity_id) GROUP BY 1, 2) SELECT country, round(avg(has::INT), 6) AS match_rate, count(*) AS n FROM c GROUP BY 1".replace("SELECT country, k.s1", "SELECT k.country, k.s1"))
def match_rate_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.match_rate(surrogate.keys(spark, sf_dir), decide.at_threshold(_owned(spark, sf_dir), 0.7)))


@query(f"{_WITH} SELECT round(avg((a.country <> b.country)::INT), 6) AS cross_country, count(*) AS links FROM scored s JOIN records a ON a.entity_id = s.s1_entity_id JOIN records b ON b.entity_id = s.cand_entity_id")
def country_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.country_audit(surrogate.scored(spark, sf_dir).select("s1_entity_id", "cand_entity_id"), surrogate.records(spark, sf_dir)))


# Files and their checks -------------------------------------------------------------------------


@query(f"{_WITH}, {_OWNED} SELECT k.s1_entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT o.cand_entity_id, ',' ORDER BY o.cand_entity_id), '') AS matched_entity_ids FROM keys k LEFT JOIN (SELECT * FROM owned WHERE calib_proba >= 0.5) o USING (s1_entity_id) GROUP BY 1")
def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.id_lists(surrogate.keys(spark, sf_dir), decide.at_threshold(_owned(spark, sf_dir), 0.5), "source1_entity_id", "matched_entity_ids")


_LISTS = f"{_WITH}, lists AS (SELECT s1_entity_id, list(cand_entity_id ORDER BY cand_entity_id) AS ids, 1 AS copy FROM scored GROUP BY 1)"
_BROKEN = """broken AS (SELECT s1_entity_id, CASE WHEN hash_no % 10 = 0 THEN list_append(ids, ids[1]) WHEN hash_no % 10 = 1 THEN list_append(ids, s1_entity_id) WHEN hash_no % 10 = 2 THEN list_append(ids, 'X9-' || s1_entity_id) WHEN hash_no % 10 = 3 THEN list_append(ids, 'S2-unknown') ELSE ids END AS ids
    FROM (SELECT *, substr(s1_entity_id, 4)::BIGINT AS hash_no FROM lists) WHERE hash_no % 10 <> 9)"""


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = surrogate.scored(spark, sf_dir).groupBy("s1_entity_id").agg(F.array_sort(F.collect_list("cand_entity_id")).alias("ids"))
    case = "case h % 10 when 0 then array_append(ids, ids[0]) when 1 then array_append(ids, s1_entity_id) when 2 then array_append(ids, 'X9-' || s1_entity_id) when 3 then array_append(ids, 'S2-unknown') else ids end"
    return lists.withColumn("h", F.expr("cast(substr(s1_entity_id, 4) as bigint)")).where("h % 10 <> 9").select("s1_entity_id", F.expr(case).alias("ids"))


@query(f"""{_LISTS}, {_BROKEN}, i AS (SELECT s1_entity_id, unnest(ids) AS id FROM broken)
SELECT * FROM (SELECT s1_entity_id, id, CASE WHEN id LIKE 'S1-%' THEN 'self' WHEN id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%' THEN 'prefix' WHEN id NOT IN (SELECT entity_id FROM records) THEN 'unknown' END AS problem FROM i) WHERE problem IS NOT NULL""")
def validate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.classed_ids(_broken(spark, sf_dir), surrogate.records(spark, sf_dir))


@query(f"""{_LISTS}, {_BROKEN} SELECT 'repeated' AS problem, s1_entity_id FROM broken WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'missing', s1_entity_id FROM keys WHERE s1_entity_id NOT IN (SELECT s1_entity_id FROM broken) UNION ALL SELECT 'outside', b.s1_entity_id FROM broken b JOIN lists l USING (s1_entity_id) WHERE len(list_filter(b.ids, lambda x: NOT list_contains(l.ids, x))) > 0""")
def validate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(_broken(spark, sf_dir), "broken")
    full = surrogate.scored(spark, sf_dir).groupBy("s1_entity_id").agg(F.collect_list("cand_entity_id").alias("ids"))
    gone, extra = validate.missing_and_extra(rows, surrogate.keys(spark, sf_dir))
    parts = [("repeated", validate.repeated_ids(rows)), ("missing", gone), ("extra", extra), ("doubled", validate.repeated_rows(rows)), ("outside", validate.outside(rows, full))]
    named = [df.select(F.lit(name).alias("problem"), "s1_entity_id") for name, df in parts]
    out = named[0]
    for df in named[1:]:
        out = out.union(df)
    return out


# Whole pipelines --------------------------------------------------------------------------------


@query(f"""{_NORMAL}, {_HOUSE_SQL}, s AS (SELECT h.*, round(0.4 * ({_JACCARD.format(a=_words_sql('a.name_core'), b=_words_sql('b.name_core'))}) + 0.35 * ({_JACCARD.format(a=_words_sql('a.addr_norm'), b=_words_sql('b.addr_norm'))}) + 0.25, 6) AS score FROM house h JOIN normal a ON a.entity_id = s1_entity_id JOIN normal b ON b.entity_id = cand_entity_id),
o AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source, cand_entity_id ORDER BY score DESC, s1_entity_id) = 1)
SELECT k.s1_entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT o.cand_entity_id, ',' ORDER BY o.cand_entity_id), '') AS matched_entity_ids FROM keys k LEFT JOIN (SELECT * FROM o WHERE score >= 0.6) o USING (s1_entity_id) GROUP BY 1""")
def link_minimum_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """House-number blocking, a baseline score, one owner, a threshold, and the list table."""
    rows = _normal(spark, sf_dir)
    pairs = blocking.house_number(rows)
    left = rows.select(F.col("entity_id").alias("s1_entity_id"), F.col("name_core").alias("a_name"), F.col("addr_norm").alias("a_addr"))
    right = rows.select(F.col("entity_id").alias("cand_entity_id"), F.col("name_core").alias("b_name"), F.col("addr_norm").alias("b_addr"))
    both = pairs.join(left, "s1_entity_id").join(right, "cand_entity_id")
    words = lambda c: sim.jaccard(sim.words(F.col(f"a_{c}")), sim.words(F.col(f"b_{c}")))
    scored = both.select("s1_entity_id", "cand_entity_id", "source", F.round(0.4 * words("name") + 0.35 * words("addr") + 0.25, 6).alias("score"), F.lit(0.0).alias("ann_sim"), F.lit(0.0).alias("tfidf_sim"))
    return tables.id_lists(surrogate.keys(spark, sf_dir), decide.at_threshold(decide.one_owner(scored, "score"), 0.6, "score"), "source1_entity_id", "matched_entity_ids")


@query()
def link_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages: blocking, re-ranking, features, trees, calibration, decision; the measures on the validation pool."""
    keys = surrogate.keys(spark, sf_dir).select("s1_entity_id")
    return pipeline.Linkage(spark).report(surrogate.records(spark, sf_dir), keys, surrogate.truth(spark, sf_dir))
