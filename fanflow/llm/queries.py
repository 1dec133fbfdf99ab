"""Queries of the operators and the SQL that gives the same rows, where SQL can."""

from fanflow.llm.align import op11_align
from fanflow.llm.decontaminate import OP5_SQL, op5_decontaminate
from fanflow.llm.hmm import op9_hmm
from fanflow.llm.language import op7_language_id
from fanflow.llm.mixing import op3_mixing
from fanflow.llm.negatives import OP12_SQL, op12_hard_negatives
from fanflow.llm.ngrams import OP13_SQL, op13_ngram_join
from fanflow.llm.quality import op2_quality
from fanflow.llm.quotes import op8_quotes
from fanflow.llm.simhash import op10_simhash
from fanflow.llm.spotsigs import OP4_SQL, SIMILAR_SQL, op4_spotsigs, spotsigs_similar
from fanflow.llm.suffixes import op6_suffix_dedup
from fanflow.llm.urls import op1_url_filter

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_spotsigs": op4_spotsigs,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_id": op7_language_id,
    "op8_quotes": op8_quotes,
    "op9_hmm": op9_hmm,
    "op10_simhash": op10_simhash,
    "op11_align": op11_align,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ngram_join": op13_ngram_join,
    "spotsigs_similar": spotsigs_similar,
}
ORACLES = {"op4_spotsigs": OP4_SQL, "op5_decontaminate": OP5_SQL, "op12_hard_negatives": OP12_SQL, "op13_ngram_join": OP13_SQL, "spotsigs_similar": SIMILAR_SQL}
