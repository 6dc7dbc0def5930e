"""Pairwise features of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.functions import similarity as sim
from weftlink.operators.blocking import FLAGS

RECORD_FIELDS = [
    "name_norm", "name_core", "name_alt", "legal_forms", "is_domain", "translit", "addr_norm", "addr_core",
    "pincode", "house_number", "numeric_tokens", "state_code", "landmark", "business_address", "country",
]
# The names and the order of the features.
FEATURES = [
    "name_lev", "name_jarowinkler", "name_token_set", "name_token_sort", "name_partial", "name_exact_core", "name_exact_norm",
    "name_first_token_match", "name_token_jaccard", "legal_form_match", "legal_form_conflict", "legal_form_missing", "either_is_domain",
    "either_translit", "name_len_ratio", "name_alt_token_set", "addr_lev", "addr_token_set", "addr_token_jaccard", "addr_numeric_jaccard",
    "house_number_match", "pincode_match", "state_match", "landmark_overlap", "addr_empty_a", "addr_empty_b", "addr_len_ratio",
    "country_match", "source_is_s2", *FLAGS, "ann_sim", "ann_rank", "tfidf_sim", "n_competitors", "rank_for_cand",
    "gap_to_best_for_cand", "rank_for_s1", "gap_to_best_for_s1",
]
BASELINE = {"name_token_set": 0.40, "addr_token_set": 0.35, "house_number_match": 0.15, "country_match": 0.10}


def compute(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """candidates with all FEATURES. Both records are joined by id; each two texts go through the string kernels that are used, once."""
    kept = [c for c in candidates.columns if c not in FEATURES]
    left = records.select(F.col("entity_id").alias("s1_entity_id"), *(F.col(c).alias(f"a_{c}") for c in RECORD_FIELDS))
    right = records.select(F.col("entity_id").alias("cand_entity_id"), *(F.col(c).alias(f"b_{c}") for c in RECORD_FIELDS))
    rows = candidates.join(left, "s1_entity_id").join(right, "cand_entity_id")
    a, b = (lambda c, side=side: F.col(f"{side}_{c}") for side in "ab")
    core = lambda side: F.when(side("name_alt") != "", side("name_alt")).otherwise(side("name_core"))
    rows = (
        rows.withColumn("_name", sim.kernels_udf(a("name_core"), b("name_core")))
        .withColumn("_alt", sim.token_set_udf(core(a), core(b)))
        .withColumn("_addr", sim.ratios_udf(a("addr_norm"), b("addr_norm")))
    )
    match, conflict, missing = sim.legal_flags(a("legal_forms"), b("legal_forms"))
    first = lambda side: F.substring_index(side("name_core"), " ", 1)
    blank = lambda side: (F.coalesce(side("business_address"), F.lit("")) == "").cast("int")
    no_landmark = (a("landmark") == "") & (b("landmark") == "")
    made = {
        "name_lev": F.col("_name.ratio"), "name_jarowinkler": F.col("_name.jaro_winkler"), "name_token_set": F.col("_name.token_set"),
        "name_token_sort": F.col("_name.token_sort"), "name_partial": F.col("_name.partial"),
        "name_exact_core": (a("name_core") == b("name_core")).cast("int"), "name_exact_norm": (a("name_norm") == b("name_norm")).cast("int"),
        "name_first_token_match": (first(a) == first(b)).cast("int"),
        "name_token_jaccard": sim.jaccard(sim.words(a("name_core")), sim.words(b("name_core"))),
        "legal_form_match": match, "legal_form_conflict": conflict, "legal_form_missing": missing,
        "either_is_domain": (a("is_domain") | b("is_domain")).cast("int"), "either_translit": (a("translit") | b("translit")).cast("int"),
        "name_len_ratio": sim.length_ratio(a("name_core"), b("name_core")),
        "name_alt_token_set": F.greatest(F.col("_name.token_set"), F.col("_alt")),
        "addr_lev": F.col("_addr.ratio"), "addr_token_set": F.col("_addr.token_set"),
        "addr_token_jaccard": sim.jaccard(sim.words(a("addr_core")), sim.words(b("addr_core"))),
        "addr_numeric_jaccard": sim.jaccard(a("numeric_tokens"), b("numeric_tokens")),
        "house_number_match": sim.tri_state(a("house_number"), b("house_number")), "pincode_match": sim.tri_state(a("pincode"), b("pincode")),
        "state_match": sim.tri_state(a("state_code"), b("state_code")),
        "landmark_overlap": F.when(no_landmark, -1.0).otherwise(sim.jaccard(sim.words(a("landmark")), sim.words(b("landmark")))),
        "addr_empty_a": blank(a), "addr_empty_b": blank(b), "addr_len_ratio": sim.length_ratio(a("addr_core"), b("addr_core")),
        "country_match": a("country").eqNullSafe(b("country")).cast("int"), "source_is_s2": (F.col("source") == "S2").cast("int"),
        **{f: F.col(f).cast("int") for f in FLAGS},
        "ann_sim": F.coalesce("ann_sim", F.lit(-1.0)), "ann_rank": F.coalesce("ann_rank", F.lit(-1)), "tfidf_sim": F.coalesce("tfidf_sim", F.lit(0.0)),
    }
    return rows.select(*kept, *((made[f] if f in made else F.col(f)).alias(f) for f in FEATURES))


def baseline_score(rows: DataFrame) -> DataFrame:
    """rows with baseline_score: a weighted sum in which a missing house number is no evidence."""
    parts = {**{c: F.col(c) for c in BASELINE}, "house_number_match": F.greatest(F.col("house_number_match"), F.lit(0))}
    return rows.withColumn("baseline_score", sum((w * parts[c] for c, w in BASELINE.items()), F.lit(0.0)))
