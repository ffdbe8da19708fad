"""The queries of this subpackage and the SQL that checks them."""

from risklake.llm.alignment import op13_alignment
from risklake.llm.bpe import op7_bpe
from risklake.llm.language_id import op11_language
from risklake.llm.language_model import op4_pseudo_likelihood
from risklake.llm.lexical_search import OP12_SQL, op12_search
from risklake.llm.mixing import op8_mix_sources
from risklake.llm.neighbours import OP1_SQL, op1_nearest
from risklake.llm.quality import op2_quality
from risklake.llm.shingles import OP3_SQL, op3_jaccard_join
from risklake.llm.substring import OP6_SQL, op6_substring_dedup
from risklake.llm.toxicity import op9_toxicity
from risklake.llm.urls import op5_url_filter
from risklake.llm.vector_dedup import OP10_SQL, op10_vector_dedup

QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_quality": op2_quality,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_pseudo_likelihood": op4_pseudo_likelihood,
    "op5_url_filter": op5_url_filter,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe": op7_bpe,
    "op8_mix_sources": op8_mix_sources,
    "op9_toxicity": op9_toxicity,
    "op10_vector_dedup": op10_vector_dedup,
    "op11_language": op11_language,
    "op12_search": op12_search,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op1_nearest": OP1_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op10_vector_dedup": OP10_SQL,
    "op12_search": OP12_SQL,
}
