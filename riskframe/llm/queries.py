"""Registered queries of the training-data operators: QUERIES by name, SQL where it can say them."""

from __future__ import annotations

from riskframe.llm import alignment, decontamination, licenses, lines, mixing, near_duplicates, packing, quality_rules, records, secrets, substrings, toxicity, trie
from riskframe.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return records.token_records(docs, tokenizer_path()).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return substrings.substring_dedup(docs, length=35, with_text=False).drop("kept_text")


def op1_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("node")


def op6_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("node")


def op7_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    """Per document: lines with a word, how many of them go, and their numbers."""
    return lines.line_counts(table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), stride=20)


def op12_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_line_dedup": op2_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op3_token_records": op3_token_records,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_packing": op13_packing,
}

SQL = {"op4_mixing": mixing.MIX_SQL.format(documents="documents")}
