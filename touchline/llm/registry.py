"""The queries of this package and their SQL."""

from __future__ import annotations

from . import decontaminate, licenses, prefixtrie, repair, urls
from .decontaminate import op1_winnowing
from .langid import op7_string_kernel
from .licenses import op2_minhash_bands
from .lmscore import op13_attention
from .media import op4_gear_chunks
from .prefixtrie import op12_prefix_trie
from .repair import op11_branch_and_bound
from .resharding import op6_min_cost_flow
from .secrets import op9_secrets
from .simhash import op5_simhash
from .subwords import op8_viterbi
from .tokencounts import op10_pretokens
from .urls import op3_bloom_cascade

QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_minhash_bands": op2_minhash_bands,
    "op3_bloom_cascade": op3_bloom_cascade,
    "op4_gear_chunks": op4_gear_chunks,
    "op5_simhash": op5_simhash,
    "op6_min_cost_flow": op6_min_cost_flow,
    "op7_string_kernel": op7_string_kernel,
    "op8_viterbi": op8_viterbi,
    "op9_secrets": op9_secrets,
    "op10_pretokens": op10_pretokens,
    "op11_branch_and_bound": op11_branch_and_bound,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_attention": op13_attention,
}
ORACLES = {
    "op1_winnowing": decontaminate.ORACLE,
    "op2_minhash_bands": licenses.ORACLE,
    "op3_bloom_cascade": urls.ORACLE,
    "op11_branch_and_bound": repair.ORACLE,
    "op12_prefix_trie": prefixtrie.ORACLE,
}
