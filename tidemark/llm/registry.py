"""The registered queries of this folder and their SQL twins, where SQL can express them."""

from __future__ import annotations

from .byte_bpe import op8_byte_bpe
from .collocations import OP11_SQL, op11_collocations
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .license_scan import op9_license_scan
from .lm_scoring import op6_lm_scores
from .merkle import op12_merkle_manifest
from .packing import op7_packing
from .quality_rules import OP3_SQL, op3_quality_rules
from .simhash import op2_simhash
from .suffix_dedup import op10_suffix_dedup
from .token_counts import op13_token_counts
from .token_files import op1_token_files
from .toxicity import op5_toxicity

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_lm_scores": op6_lm_scores,
    "op7_packing": op7_packing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_license_scan": op9_license_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_collocations": op11_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
}

SQL = {
    "op3_quality_rules": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op11_collocations": OP11_SQL,
}
