"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from posmetrics.llm import (
    alignment,
    byte_bpe,
    chat,
    decontaminate,
    embedding_dedup,
    language,
    merkle,
    minhash_dedup,
    mixing,
    personal_data,
    token_counts,
    token_files,
    url_filter,
)

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.op1_embedding_dedup,
    "op2_personal_data": personal_data.op2_personal_data,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_chat_format": chat.op4_chat_format,
    "op5_minhash_dedup": minhash_dedup.op5_minhash_dedup,
    "op6_language": language.op6_language,
    "op7_token_files": token_files.op7_token_files,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_alignment": alignment.op11_alignment,
    "op12_mixing": mixing.op12_mixing,
    "op13_merkle": merkle.op13_merkle,
}

ORACLE: dict[str, str] = {
    "op4_chat_format": chat.OP4_SQL,
    "op12_mixing": mixing.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
