"""The registered corpus queries and the SQL that checks them."""

from __future__ import annotations

from reportweave.llm import (
    bpe,
    chat_format,
    collocations,
    exact_dedup,
    filter_audit,
    html_text,
    language_id,
    mixing,
    near_dedup,
    sharding,
    substring_dedup,
    top_k,
    warc,
)

CORPUS_QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_sharding": sharding.op2_sharding,
    "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_byte_bpe": bpe.op5_byte_bpe,
    "op6_exact_top_k": top_k.op6_exact_top_k,
    "op7_html_text": html_text.op7_html_text,
    "op8_warc": warc.op8_warc,
    "op9_mixing": mixing.op9_mixing,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_collocations": collocations.op11_collocations,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

CORPUS_SQL = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op6_exact_top_k": top_k.SQL,
    "op8_warc": warc.SQL,
    "op9_mixing": mixing.SQL,
    "op10_chat_format": chat_format.SQL,
    "op11_collocations": collocations.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_substring_dedup": substring_dedup.SQL,
}
