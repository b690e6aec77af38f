"""The registered queries of this subpackage and, where SQL can say them, their SQL."""

from __future__ import annotations

from .chat import OP7_SQL, op7_format_chats
from .decontaminate import op2_decontaminate
from .language import op4_language_id
from .lattice import op8_lm_score
from .minmax import op3_minhash_dedup
from .licences import op5_licence_scan
from .mixing import OP6_SQL, op6_mix_sources
from .ngrams import op11_ngram_join
from .negatives import OP13_SQL, op13_hard_negatives
from .pii import op9_pii
from .quality import op10_quality_rules
from .secrets import OP1_SQL, op1_secret_scan
from .trie import OP12_SQL, op12_prefix_trie

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_language_id": op4_language_id,
    "op5_licence_scan": op5_licence_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_format_chats": op7_format_chats,
    "op8_lm_score": op8_lm_score,
    "op9_pii": op9_pii,
    "op10_quality_rules": op10_quality_rules,
    "op11_ngram_join": op11_ngram_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_secret_scan": OP1_SQL,
    "op6_mix_sources": OP6_SQL,
    "op7_format_chats": OP7_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
