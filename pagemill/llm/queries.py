"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from .decontaminate import OP2_SQL, op2_decontaminate
from .multiset import op7_multiset_hash
from .packing import op1_best_fit_packing
from .pseudonyms import op3_pii
from .quality import op9_quality
from .reputation import OP12_SQL, op12_url_reputation
from .ring import op6_ring_shards
from .secrets import op10_secrets
from .simhash import op4_simhash
from .tokencount import op8_token_counts
from .turns import OP11_SQL, op11_turn_repair
from .warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontaminate": op2_decontaminate,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_ring_shards": op6_ring_shards,
    "op7_multiset_hash": op7_multiset_hash,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_turn_repair": op11_turn_repair,
    "op12_url_reputation": op12_url_reputation,
}

ORACLE = {"op2_decontaminate": OP2_SQL, "op5_warc": OP5_SQL, "op11_turn_repair": OP11_SQL, "op12_url_reputation": OP12_SQL}
