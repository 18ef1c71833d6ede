"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tessera.llm import bpe, collocations, imatch, jaccard_join, licenses, main_text, oracles, packing, quality, spelling, suffix_dedup, toxicity, url_filter, warc

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_quality": quality.op2_quality,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_imatch": imatch.op4_imatch,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_ngram_jaccard": jaccard_join.op6_ngram_jaccard,
    "op7_packing": packing.op7_packing,
    "op8_licenses": licenses.op8_licenses,
    "op9_warc": warc.op9_warc,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_spelling": spelling.op11_spelling,
    "op12_main_text": main_text.op12_main_text,
    "op13_collocations": collocations.op13_collocations,
}
ORACLE_SQL = oracles.ORACLE_SQL | {"op13_collocations": collocations.ORACLE_SQL}
