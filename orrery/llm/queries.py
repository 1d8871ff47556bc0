"""The operators bound to the driver tables: query name -> builder, and DuckDB oracles."""

from __future__ import annotations

from . import alignment, chat, classifier, katz, language, lattice, licenses, mixing, neardup, packing, repetition, spelling, urls

QUERIES = {
    "op1_source_mixing": mixing.op1,
    "op2_quality_rules": repetition.op2,
    "op3_katz_scoring": katz.op3,
    "op4_language_id": language.op4,
    "op5_packing": packing.op5,
    "op6_quality_classifier": classifier.op6,
    "op7_near_dedup": neardup.op7,
    "op8_url_filter": urls.op8,
    "op9_vector_near_dedup": lattice.op9,
    "op10_license_scan": licenses.op10,
    "op11_spelling_variants": spelling.op11,
    "op12_tokenizer_alignment": alignment.op12,
    "op13_chat_examples": chat.op13,
}

ORACLES = {
    "op8_url_filter": urls.OP8_SQL,
}
