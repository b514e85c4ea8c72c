"""The registered queries of this subpackage and their checking SQL. Each runs over its whole table."""

from __future__ import annotations

from millrace.llm import (
    ann, bpe, decontaminate, licenses, lm, near_dedup, piece_bpe, prefix_trie, secrets, suffix_dedup, token_output, toxicity, vector_codes)
from millrace.llm.common import table
from millrace.session import work_dir


def tokenizer_path() -> str:
    """The vocabulary file that the registered queries use; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_path() -> str:
    """The SentencePiece file that the registered queries use; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


QUERIES = {
    "op1_suffix_dedup": lambda spark, d: suffix_dedup.report(table(spark, d, "documents")),
    "op2_bpe": lambda spark, d: bpe.digests(table(spark, d, "documents"), tokenizer_path()),
    "op3_decontaminate": lambda spark, d: decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_licenses": lambda spark, d: licenses.report(table(spark, d, "documents")),
    "op5_secrets": lambda spark, d: secrets.report(table(spark, d, "documents")),
    "op6_toxicity": lambda spark, d: toxicity.grade_documents(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_near_dedup": lambda spark, d: near_dedup.classes(table(spark, d, "documents"), size=3, num=85, den=100),
    "op8_token_output": lambda spark, d: token_output.report(table(spark, d, "documents"), tokenizer_path(), work_dir(spark, "token-files")),
    "op9_ann": lambda spark, d: ann.nearest(table(spark, d, "embeddings")),
    "op10_lm_score": lambda spark, d: lm.score(table(spark, d, "documents")),
    "op11_vector_codes": lambda spark, d: vector_codes.report(table(spark, d, "embeddings")),
    "op12_prefix_trie": lambda spark, d: prefix_trie.trie(table(spark, d, "conversations")),
    "op13_sentencepiece": lambda spark, d: piece_bpe.digests(table(spark, d, "documents"), pieces_path()),
}

ORACLES = {
    "op1_suffix_dedup": suffix_dedup.SQL,
    "op3_decontaminate": decontaminate.SQL,
    "op7_near_dedup": near_dedup.SQL,
    "op9_ann": ann.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
