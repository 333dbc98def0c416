"""The queries of the training-data operators, by name."""

from __future__ import annotations

from . import line_dedup, substring_dedup
from .conversation_repair import op11_conversation_repair
from .cross_tokenizer import op12_cross_tokenizer
from .fingerprints import op4_document_fingerprints
from .line_dedup import op3_line_dedup
from .packing import op10_best_fit_packing
from .quality_classifier import op1_quality_classifier
from .quality_rules import op7_quality_rules
from .secrets import op9_secret_scans
from .sentencepiece_unigram import op8_sentencepiece
from .simhash import op6_simhash_near_dedup
from .substring_dedup import op2_substring_dedup
from .superminhash import op13_superminhash_near_dedup
from .toxicity import op5_toxicity

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_secret_scans": op9_secret_scans,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_superminhash_near_dedup": op13_superminhash_near_dedup,
}

#: DuckDB SQL for those that SQL can express.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
}
