"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontamination, exact_search, main_text, mixing, near_duplicates, phrases, preference, secrets, substrings, toxicity, url_filter, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_preference": preference.op1_preference,
        "op2_near_duplicates": near_duplicates.op2_near_duplicates,
        "op3_url_filter": url_filter.op3_url_filter,
        "op4_mixing": mixing.op4_mixing,
        "op5_decontamination": decontamination.op5_decontamination,
        "op6_main_text": main_text.op6_main_text,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_substrings": substrings.op8_substrings,
        "op9_secrets": secrets.op9_secrets,
        "op10_ann": ann.op10_ann,
        "op11_exact_search": exact_search.op11_exact_search,
        "op12_phrases": phrases.op12_phrases,
        "op13_vector_codes": vector_codes.op13_vector_codes,
        "url_rules": url_filter.url_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_preference": preference.OP1_SQL,
        "op2_near_duplicates": near_duplicates.OP2_SQL,
        "op8_substrings": substrings.OP8_SQL,
        "op11_exact_search": exact_search.OP11_SQL,
        "op12_phrases": phrases.OP12_SQL,
        "op13_vector_codes": vector_codes.OP13_SQL,
        "url_rules": url_filter.URL_RULES_SQL,
    }
