"""Queries of the training-data operators and their DuckDB formulations."""

from __future__ import annotations

from allelic.llm.byte_bpe import op13_byte_bpe
from allelic.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from allelic.llm.fixity import OP8_SQL, op8_fixity
from allelic.llm.jaccard_join import op2_jaccard_join
from allelic.llm.licenses import OP10_SQL, op10_licenses
from allelic.llm.lm_scoring import op1_lm_scoring
from allelic.llm.mixing import OP3_SQL, op3_mixing
from allelic.llm.packing import op6_packing
from allelic.llm.phrases import OP11_SQL, op11_phrases
from allelic.llm.quality import op7_quality
from allelic.llm.secrets import op9_secrets
from allelic.llm.suffix_dedup import op5_suffix_dedup
from allelic.llm.variants import op12_variants

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_fixity": op8_fixity,
    "op9_secrets": op9_secrets,
    "op10_licenses": op10_licenses,
    "op11_phrases": op11_phrases,
    "op12_variants": op12_variants,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLE_SQL = {
    "op3_mixing": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op8_fixity": OP8_SQL,
    "op10_licenses": OP10_SQL,
    "op11_phrases": OP11_SQL,
}
