"""Queries of this subpackage and their DuckDB SQL, for the driver's entry module."""

from __future__ import annotations

from . import (bpe, collocations, decontaminate, html_text, langid, lm_score, near_dedup, periodic_runs, quality, sharding, substring_dedup,
               suffix_dedup, url_filter)

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_bpe": bpe.op4_bpe,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_quality": quality.op8_quality,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_langid": langid.op10_langid,
    "op11_sharding": sharding.op11_sharding,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_collocations": collocations.op13_collocations,
}
ORACLES: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op9_suffix_dedup": suffix_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}


def registry() -> dict:
    return {name: (run, ORACLES.get(name)) for name, run in QUERIES.items()}
