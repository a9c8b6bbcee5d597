"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import decontaminate, exact_dedup, licenses, packing, pii, quality, secrets, simhash, spelling, token_store, toxicity, trie, url_filter

    return {
        "op1_decontamination": decontaminate.op1_decontamination,
        "op2_token_ids": token_store.op2_token_ids,
        "op3_url_filter": url_filter.op3_url_filter,
        "op4_quality": quality.op4_quality,
        "op5_secrets": secrets.op5_secrets,
        "op6_packing": packing.op6_packing,
        "op7_pii": pii.op7_pii,
        "op8_simhash": simhash.op8_simhash,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_licenses": licenses.op10_licenses,
        "op11_prefix_trie": trie.op11_prefix_trie,
        "op12_spelling": spelling.op12_spelling,
        "op13_toxicity": toxicity.op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    from . import decontaminate, exact_dedup, spelling, trie

    return {"op1_decontamination": decontaminate.OP1_SQL, "op9_exact_dedup": exact_dedup.OP9_SQL, "op11_prefix_trie": trie.OP11_SQL, "op12_spelling": spelling.OP12_SQL}
