"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from martlake.llm.byte_bpe import op11_byte_bpe
from martlake.llm.edit_counts import op4_edit_counts
from martlake.llm.lexical import op12_lexical_search
from martlake.llm.mixing import op1_mixing
from martlake.llm.near_dedup import op7_near_dedup
from martlake.llm.phrases import op13_phrases
from martlake.llm.pii import op3_pii
from martlake.llm.piece_encoder import op2_piece_encoding
from martlake.llm.prefix_forest import op10_prefix_forest
from martlake.llm.quality import op9_quality_rules
from martlake.llm.sql import SQL  # noqa: F401
from martlake.llm.substring_dedup import op5_substring_dedup
from martlake.llm.url_rules import op8_url_equivalence
from martlake.llm.warc import op6_warc_revisits

QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_piece_encoding, op3_pii, op4_edit_counts, op5_substring_dedup, op6_warc_revisits,
    op7_near_dedup, op8_url_equivalence, op9_quality_rules, op10_prefix_forest, op11_byte_bpe,
    op12_lexical_search, op13_phrases)}
