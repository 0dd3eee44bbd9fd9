"""Queries of the text operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from ledgerlake.llm import chat, license_scan, merkle, ngram_join, setsketch, spelling
from ledgerlake.llm.bpe import op6_byte_bpe
from ledgerlake.llm.chat import op4_perspective_rotation
from ledgerlake.llm.decontaminate import op10_bm25_decontamination
from ledgerlake.llm.fingerprint import op7_multiset_fingerprint
from ledgerlake.llm.license_scan import op5_license_sentences
from ledgerlake.llm.line_dedup import op2_line_chunk_dedup
from ledgerlake.llm.merkle import op13_merkle_manifest
from ledgerlake.llm.ngram_join import op8_ngram_jaccard
from ledgerlake.llm.pii import op1_contextual_pii
from ledgerlake.llm.quality import op9_quality_random_indexing
from ledgerlake.llm.setsketch import op12_setsketch_dedup
from ledgerlake.llm.spelling import op11_spelling_variants
from ledgerlake.llm.toxicity import op3_toxicity_cnn

QUERIES = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_line_chunk_dedup": op2_line_chunk_dedup,
    "op3_toxicity_cnn": op3_toxicity_cnn,
    "op4_perspective_rotation": op4_perspective_rotation,
    "op5_license_sentences": op5_license_sentences,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_multiset_fingerprint": op7_multiset_fingerprint,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_quality_random_indexing": op9_quality_random_indexing,
    "op10_bm25_decontamination": op10_bm25_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_setsketch_dedup": op12_setsketch_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Only where SQL expresses the operator; the others are tested against brute force, round trips or held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op4_perspective_rotation": chat.ORACLE_SQL,
    "op5_license_sentences": license_scan.oracle_sql(),
    "op8_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_setsketch_dedup": setsketch.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
