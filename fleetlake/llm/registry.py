"""Queries of this subpackage and their SQL, where SQL can express them."""

from fleetlake.llm import (annsearch, bitkmeans, bpe, capjoin, langid, lexsearch, mixing, passages, setjoin, sharding, tokenfiles, toxicity,
                           urlfilter)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_jaccard_join": setjoin.op2_jaccard_join,
    "op3_passages": passages.op3_passages,
    "op4_cap_join": capjoin.op4_cap_join,
    "op5_sharding": sharding.op5_sharding,
    "op6_token_files": tokenfiles.op6_token_files,
    "op7_language_id": langid.op7_language_id,
    "op8_bpe": bpe.op8_bpe,
    "op9_ann": annsearch.op9_ann,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_url_filter": urlfilter.op11_url_filter,
    "op12_bit_kmeans": bitkmeans.op12_bit_kmeans,
    "op13_lexical_search": lexsearch.op13_lexical_search,
}

ORACLE = {
    "op1_mixing": mixing.ORACLE,
    "op11_url_filter": urlfilter.ORACLE,
    "op12_bit_kmeans": bitkmeans.ORACLE,
    "op13_lexical_search": lexsearch.ORACLE,
}
