"""The dealt operators' registered queries and their DuckDB SQL."""

from __future__ import annotations

from .alignment import op11_alignment
from .byte_gru import op8_language
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .hidden_markov import op13_hidden_markov
from .licenses import op5_licenses
from .nbsvm import op2_quality
from .packing import op10_packing
from .periodic_runs import op12_periodic_runs
from .piece_codec import op4_sentencepiece
from .pii import op6_pii
from .probminhash import op9_near_dedup
from .reply_trees import OP3_SQL, op3_chat
from .rules_forest import op7_quality_rules

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_chat": op3_chat,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_quality_rules": op7_quality_rules,
    "op8_language": op8_language,
    "op9_near_dedup": op9_near_dedup,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hidden_markov": op13_hidden_markov,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op3_chat": OP3_SQL,
}
