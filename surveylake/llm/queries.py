"""The registered queries of the operators, and the SQL of those that have one."""

from __future__ import annotations

from surveylake.llm.byte_bpe import op6_byte_bpe
from surveylake.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from surveylake.llm.mixing import OP13_SQL, op13_mixing
from surveylake.llm.near_join import op8_ngram_jaccard_join
from surveylake.llm.packing import op10_best_fit_packing
from surveylake.llm.quality_rules import OP1_SQL, op1_quality_rules
from surveylake.llm.sharding import op5_sharding
from surveylake.llm.spelling import op11_spelling_variants
from surveylake.llm.toxicity import op9_toxicity
from surveylake.llm.token_counts import op3_token_counts
from surveylake.llm.url_filters import OP7_SQL, op7_url_filters
from surveylake.llm.warc import OP4_SQL, op4_warc
from surveylake.llm.whitening import op12_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_exact_dedup,
        op3_token_counts,
        op4_warc,
        op5_sharding,
        op6_byte_bpe,
        op7_url_filters,
        op8_ngram_jaccard_join,
        op9_toxicity,
        op10_best_fit_packing,
        op11_spelling_variants,
        op12_embedding_whitening,
        op13_mixing,
    )
}
ORACLE_SQL = {"op1_quality_rules": OP1_SQL, "op2_exact_dedup": OP2_SQL, "op4_warc": OP4_SQL, "op7_url_filters": OP7_SQL, "op13_mixing": OP13_SQL}
