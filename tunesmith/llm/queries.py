"""The queries of this folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunesmith.llm import ball_tree, bit_planes, block_max, chains, gram_variants, host_rules, minhash, packing, piece_sampling, rabitq, secret_scan, token_counts, warc
from tunesmith.llm.tokens import id_column, word_ids
from tunesmith.sources.scratch import new_path
from tunesmith.sources.tables import table

BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
END_OF_DOCUMENT, END_OF_PACKED = 2, 0


def packed(documents: DataFrame) -> DataFrame:
    vocabulary = public_tokenizers.path(BYTE_BPE)
    return packing.digests(packing.pieces(documents, lambda text: id_column(text, vocabulary, END_OF_PACKED)))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op9_chains(spark: SparkSession, folder: str) -> DataFrame:
    return chains.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


def op1_rabitq(spark: SparkSession, folder: str) -> DataFrame:
    return rabitq.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.page_records(warc.read_warc(spark, path))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), 85)


def op4_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.quality(table(spark, folder, "documents"))


def op5_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return piece_sampling.round_trips(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


def op7_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    path, vocabulary = new_path(spark, "planes"), public_tokenizers.path(WORD_BPE)
    bit_planes.write_planes(table(spark, folder, "documents"), path, lambda: word_ids(vocabulary), END_OF_DOCUMENT)
    return bit_planes.document_starts(bit_planes.read_planes(spark, path))


def op11_ball_tree(spark: SparkSession, folder: str) -> DataFrame:
    return ball_tree.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_gram_variants(spark: SparkSession, folder: str) -> DataFrame:
    return gram_variants.variants(table(spark, folder, "documents"))


def op13_block_max(spark: SparkSession, folder: str) -> DataFrame:
    return block_max.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_rabitq": op1_rabitq,
    "op2_warc": op2_warc,
    "op3_minhash": op3_minhash,
    "op4_host_rules": op4_host_rules,
    "op5_piece_sampling": op5_piece_sampling,
    "op6_secret_scan": op6_secret_scan,
    "op7_bit_planes": op7_bit_planes,
    "op8_packing": op8_packing,
    "op9_chains": op9_chains,
    "op10_token_counts": op10_token_counts,
    "op11_ball_tree": op11_ball_tree,
    "op12_gram_variants": op12_gram_variants,
    "op13_block_max": op13_block_max,
}
