"""The registered queries of this subpackage and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, hamming, importance, langid, licences, mixing, negatives, pii, simhash, tokenfiles, urls, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_embedding_dedup": vectors.op2_embedding_dedup,
    "op3_token_files": tokenfiles.op3_token_files,
    "op4_personal_data": pii.op4_personal_data,
    "op5_language_id": langid.op5_language_id,
    "op6_simhash": simhash.op6_simhash,
    "op7_license_scan": licences.op7_license_scan,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_hamming_topk": hamming.op9_hamming_topk,
    "op10_mixing": mixing.op10_mixing,
    "op11_url_filter": urls.op11_url_filter,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_importance_resampling": importance.op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {"op1_chat_format": chat.SQL, "op7_license_scan": licences.SQL, "op9_hamming_topk": hamming.SQL, "op11_url_filter": urls.SQL, "op12_hard_negatives": negatives.SQL}
