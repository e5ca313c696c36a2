"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from .byte_bpe import op7_byte_bpe
from .conversation_trie import OP12_SQL, op12_conversation_trie
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .imatch import op10_imatch
from .language_id import op4_language_id
from .oracles import OP1_SQL, OP9_SQL
from .packing import op3_best_fit_packing
from .quality import op9_quality_rules
from .secrets import OP11_SQL, op11_secret_scan
from .simhash import op2_simhash
from .substring_dedup import op1_substring_dedup
from .suffix_dedup import op8_suffix_dedup
from .toxicity import op5_toxicity
from .url_filter import OP6_SQL, op6_url_filter

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_simhash, op3_best_fit_packing, op4_language_id, op5_toxicity, op6_url_filter, op7_byte_bpe, op8_suffix_dedup, op9_quality_rules, op10_imatch, op11_secret_scan, op12_conversation_trie, op13_hard_negatives)}
ORACLES = {"op1_substring_dedup": OP1_SQL, "op6_url_filter": OP6_SQL, "op9_quality_rules": OP9_SQL, "op11_secret_scan": OP11_SQL, "op12_conversation_trie": OP12_SQL, "op13_hard_negatives": OP13_SQL}
