"""The registered queries of this subpackage and the SQL they must equal."""

from __future__ import annotations

from .bpe import op7_byte_bpe
from .centroids import OP12_SQL, op12_centroids
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .jaccard_join import op9_jaccard_join
from .lang_id import op4_language_id
from .mixing import op3_mixing
from .sharding import op10_sharding
from .suffix_dedup import op8_suffix_dedup
from .topk import OP5_SQL, op5_topk
from .toxicity import op13_toxicity
from .url_filter import OP6_SQL, op6_url_filter
from .vector_codes import OP11_SQL, op11_vector_codes
from .warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_topk": op5_topk,
    "op6_url_filter": op6_url_filter,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_centroids": op12_centroids,
    "op13_toxicity": op13_toxicity,
}
ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op5_topk": OP5_SQL,
    "op6_url_filter": OP6_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_centroids": OP12_SQL,
}
