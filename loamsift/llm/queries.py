"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from loamsift.llm import chat_format, decontaminate, hamming_search, language_id, license_scan, ngram_join, packing, quality_nbsvm, suffix_dedup, warc_zstd

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_quality_classifier": quality_nbsvm.op2_quality_classifier,
    "op3_warc": warc_zstd.op3_warc,
    "op4_ngram_jaccard": ngram_join.op4_ngram_jaccard,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_hamming_search": hamming_search.op6_hamming_search,
    "op7_language_id": language_id.op7_language_id,
    "op8_packing": packing.op8_packing,
    "op9_chat_formatting": chat_format.op9_chat_formatting,
    "op10_suffix_array_dedup": suffix_dedup.op10_suffix_array_dedup,
}

ORACLES: dict[str, str] = {
    "op3_warc": warc_zstd.ORACLE,
    "op4_ngram_jaccard": ngram_join.ORACLE,
    "op5_decontamination": decontaminate.ORACLE,
    "op9_chat_formatting": chat_format.ORACLE,
    "op10_suffix_array_dedup": suffix_dedup.ORACLE,
}
