"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm.codes import OP11_SQL, op11_vector_codes
from tidemark.llm.extraction import op7_html_extraction
from tidemark.llm.langid import op9_language_id
from tidemark.llm.lm import op8_lm_scoring
from tidemark.llm.mixing import OP1_SQL, op1_mixing
from tidemark.llm.negatives import OP12_SQL, op12_hard_negatives
from tidemark.llm.ngram_join import op3_ngram_join
from tidemark.llm.packing import op2_packing
from tidemark.llm.pieces import op13_pieces
from tidemark.llm.quality import OP4_SQL, op4_quality
from tidemark.llm.spotsigs import op10_fingerprints
from tidemark.llm.substrings import op5_substring_dedup
from tidemark.llm.warc import op6_warc

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_ngram_join": op3_ngram_join,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_warc": op6_warc,
    "op7_html_extraction": op7_html_extraction,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_language_id": op9_language_id,
    "op10_fingerprints": op10_fingerprints,
    "op11_vector_codes": op11_vector_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pieces": op13_pieces,
}

SQL = {
    "op1_mixing": OP1_SQL,
    "op4_quality": OP4_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
