"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, collocations, decontamination, language, licenses, packing, quality, repeats, sentencepieces, simhash, token_counts, token_output, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": token_output.op1,
    "op2_license_scan": licenses.op2,
    "op3_simhash_near_duplicates": simhash.op3,
    "op4_language_id": language.op4,
    "op5_token_counts": token_counts.op5,
    "op6_sentencepiece": sentencepieces.op6,
    "op7_repeated_bytes": repeats.op7,
    "op8_packing": packing.op8,
    "op9_quality_rules": quality.op9,
    "op10_nearest_neighbours": ann.op10,
    "op11_collocations": collocations.op11,
    "op12_spelling_variants": variants.op12,
    "op13_decontamination": decontamination.op13,
}

#: DuckDB statements for the results that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op11_collocations": collocations.SQL,
    "op12_spelling_variants": variants.SQL,
    "op13_decontamination": decontamination.SQL,
}
