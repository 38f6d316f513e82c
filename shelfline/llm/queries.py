"""Registry of this package: query keys and DuckDB texts.  The driver's view
of it is ``QUERIES`` and ``ORACLE``."""

from __future__ import annotations

from shelfline.llm import (compression_bands, conversation_repair, crf, cutting_stock, digest_array,
                           external_shuffle, heavy_hitters, license_tfidf, merkle, nbsvm, ngram_join, spaced_seeds, token_efficiency)

QUERIES = {f.__name__: f for f in (
    cutting_stock.op1_cutting_stock,
    nbsvm.op2_nbsvm,
    license_tfidf.op3_license_tfidf,
    token_efficiency.op4_token_efficiency,
    spaced_seeds.op5_spaced_seeds,
    crf.op6_crf,
    compression_bands.op7_compression_bands,
    external_shuffle.op8_external_shuffle,
    digest_array.op9_digest_array,
    ngram_join.op10_ngram_join,
    merkle.op11_merkle,
    heavy_hitters.op12_heavy_hitters,
    conversation_repair.op13_conversation_repair,
)}

ORACLE: dict[str, str] = {
    "op9_digest_array": digest_array.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op11_merkle": merkle.ORACLE_SQL,
    "op12_heavy_hitters": heavy_hitters.ORACLE_SQL,
}
