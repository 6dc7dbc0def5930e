"""Business records, truth and scored pairs derived from the part table.

The statements keep to what Spark SQL and DuckDB share, so both sides of a check read the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SYLLABLES = "'babedibodukafelimonuparesitovuxa'"


def _syllable(step: int) -> str:
    return f"substr({_SYLLABLES}, CAST(2 * (CAST(floor(k / {step}) AS BIGINT) % 16) + 1 AS INT), 2)"


def _pick(value: str, *choices: str) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(choices[:-1])) + f" ELSE '{choices[-1]}' END"


_BASE = f"""
SELECT k, p_name AS thing, {_syllable(1)} || {_syllable(16)} || {_syllable(256)} AS clan, {_pick('k % 3', 'US', 'India', 'France')} AS country,
    CAST((k * 7) % 900 + 1 AS STRING) AS house,
    {_pick('CAST(floor(k / 5) AS BIGINT) % 6', 'Oak Road', 'Mill Street', 'Second Avenue', 'Lake Lane', 'Hill Drive', 'Park Place')} AS street,
    {_pick('CAST(floor(k / 5) AS BIGINT) % 6', 'Oak Rd', 'Mill St', '2nd Ave', 'Lake Ln', 'Hill Dr', 'Park Pl')} AS short_street,
    CASE k % 3 WHEN 0 THEN {_pick('CAST(floor(k / 3) AS BIGINT) % 4', 'Texas', 'New York', 'Ohio', 'West Virginia')}
        WHEN 1 THEN {_pick('CAST(floor(k / 3) AS BIGINT) % 4', 'Karnataka', 'Kerala', 'Tamil Nadu', 'Delhi')}
        ELSE {_pick('CAST(floor(k / 3) AS BIGINT) % 4', 'Bretagne', 'Occitanie', 'Grand Est', 'Corse')} END AS state,
    {_pick('CAST(floor(k / 3) AS BIGINT) % 4', 'Bangalore', 'Springfield', 'Lyon', 'Madras')} AS city,
    CASE WHEN k % 3 = 1 THEN CAST(100000 + (k * 991) % 899999 AS STRING) ELSE CAST(10000 + (k * 37) % 89999 AS STRING) END AS code
FROM (SELECT p_partkey AS k, p_name FROM part) p
"""

RECORDS = f"""
SELECT k, 'S1' AS source, 'S1-' || lpad(CAST(k AS STRING), 9, '0') AS entity_id, country,
    CASE WHEN k % 7 = 0 THEN 'The ' ELSE '' END || thing || ' ' || clan || CASE WHEN k % 5 = 0 THEN ' & Sons' ELSE '' END
        || {_pick('k % 6', ' Private Limited', ' Inc', ' Company', '', ' LLC', ' SARL')} AS business_name,
    house || ' ' || street || ', ' || city || ', ' || state || ' ' || code AS business_address
FROM ({_BASE}) b
UNION ALL
SELECT k, 'S2', 'S2-' || lpad(CAST(k AS STRING), 9, '0'), country,
    CASE WHEN k % 14 = 0 THEN '## (' || clan || ') ' WHEN k % 38 = 0 THEN 'Café Noël ' ELSE '' END || CASE WHEN k % 4 = 0 THEN clan || ' ' || thing ELSE upper(thing) || ' ' || clan END || {_pick('k % 6', ' Pvt. Ltd.', ' Inc.', ' Co', ' Ltd', ' LLC LLC', ' sarl')}
        || CASE WHEN k % 10 = 0 THEN ' dba ' || thing || ' store' WHEN k % 22 = 0 THEN ' d/b/a ' || thing || ' depot' WHEN k % 26 = 0 THEN ' Trading As <' || clan || '>' WHEN k % 34 = 0 THEN ' | since 1990' ELSE '' END,
    CASE WHEN k % 8 = 0 THEN 'Near ' || city || ' Mall, ' ELSE '' END || house || ' ' || short_street || ', ' || city || ', ' || state || ' ' || code
FROM ({_BASE}) b WHERE k % 2 = 0
UNION ALL
SELECT k, 'S3', 'S3-' || lpad(CAST(k AS STRING), 9, '0'), country,
    CASE WHEN k % 9 = 0 THEN clan || '.com ' || thing ELSE thing || ' ' || substr(clan, 1, 5) END || {_pick('k % 6', ' pvt', ' Corp', ' company', '', ' llc', ' SAS')},
    CASE WHEN k % 15 = 0 THEN '' ELSE CASE WHEN k % 9 = 2 THEN 'Town Hall ke pas, ' ELSE '' END || '00' || house || ' ' || street || CASE WHEN k % 12 = 3 THEN ', City of ' || city ELSE '' END || ', ' || state END
FROM ({_BASE}) b WHERE k % 3 <> 1
"""

SCORED = f"""
SELECT s.entity_id AS s1_entity_id, c.entity_id AS cand_entity_id, c.source, s.country,
    CASE WHEN s.k = c.k THEN CAST(600 + (s.k * 31) % 400 AS DOUBLE) / CAST(1000 AS DOUBLE) ELSE CAST((s.k * 7919 + c.k * 104729) % 700 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS calib_proba,
    CAST((s.k * 13 + c.k * 7) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS ann_sim,
    CAST((s.k * 3 + c.k * 11) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS tfidf_sim,
    (s.k + c.k) % 2 = 0 AS from_ann, (s.k + c.k) % 3 = 0 AS from_phonetic, (s.k + c.k) % 5 = 0 AS from_sn, s.k = c.k AS from_housenum,
    CASE WHEN (s.k + c.k) % 2 = 0 THEN CAST((s.k + c.k) % 20 AS INT) ELSE -1 END AS ann_rank
FROM (SELECT * FROM ({RECORDS}) r WHERE source = 'S1') s
JOIN (SELECT * FROM ({RECORDS}) r WHERE source <> 'S1') c ON floor(s.k / 6) = floor(c.k / 6)
"""

TRUTH = f"""
SELECT 'S1-' || lpad(CAST(k AS STRING), 9, '0') AS s1_entity_id, entity_id AS cand_entity_id FROM ({RECORDS}) r WHERE source <> 'S1' AND k % 11 <> 0
"""

KEYS = f"SELECT entity_id AS s1_entity_id, country FROM ({RECORDS}) r WHERE source = 'S1'"


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the statements over a scale folder's part table."""
    name = "part_" + "".join(c if c.isalnum() else "_" for c in sf_dir)
    spark.read.parquet(f"{sf_dir}/part.parquet").createOrReplaceTempView(name)
    return spark.sql(sql.replace("FROM part)", f"FROM {name})"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RECORDS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, SCORED)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, TRUTH)


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, KEYS)
