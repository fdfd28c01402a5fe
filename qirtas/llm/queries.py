"""The queries of this folder and their SQL, where SQL can express them."""

from __future__ import annotations

from qirtas.llm import lexical_search, merkle, quality_rules, url_reputation, warc
from qirtas.llm.bpe import op8_bpe
from qirtas.llm.cover_tree import SQL as COVER_TREE_SQL
from qirtas.llm.cover_tree import op10_cover_tree
from qirtas.llm.mil_classifier import op4_mil_classifier
from qirtas.llm.ngram_join import op3_ngram_join
from qirtas.llm.packing import op6_packing
from qirtas.llm.simhash import op13_simhash
from qirtas.llm.substring_dedup import op9_substring_dedup
from qirtas.llm.token_counts import op5_token_counts

QUERIES = {
    "op1_url_reputation": url_reputation.op1_url_reputation,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_ngram_join": op3_ngram_join,
    "op4_mil_classifier": op4_mil_classifier,
    "op5_token_counts": op5_token_counts,
    "op6_packing": op6_packing,
    "op7_warc": warc.op7_warc,
    "op8_bpe": op8_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_cover_tree": op10_cover_tree,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_simhash": op13_simhash,
}
SQL = {
    "op1_url_reputation": url_reputation.SQL,
    "op2_quality_rules": quality_rules.SQL,
    "op7_warc": warc.SQL,
    "op10_cover_tree": COVER_TREE_SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_lexical_search": lexical_search.SQL,
}
