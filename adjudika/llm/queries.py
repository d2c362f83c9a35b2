"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers

from adjudika.llm import (codes, decontaminate, licences, minhash, pieces, pii, quality_model, quality_rules, sharding, substrings, tokens, toxicity,
                          whitening)
from adjudika.llm.registry import QUERIES, SQL, query, table
from adjudika.session import work_dir

__all__ = ["QUERIES", "SQL"]

#: Bytes of text in a shard at most.
SHARD_BYTES = 1 << 20
#: The key of the registered queries' pseudonyms; a real corpus needs a secret one.
PII_KEY = "registered queries"


@query("op1_licence_scan")
def op1_licence_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_token_output")
def op3_token_output(spark, sf_dir):
    path = f"{work_dir(spark, 'tokens')}/table"
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokens.read_digests(spark, path)


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def op5_quality_classifier(spark, sf_dir):
    return quality_model.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_pii_pseudonyms")
def op6_pii_pseudonyms(spark, sf_dir):
    return pii.pseudonymised(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_private")


@query("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark, sf_dir):
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark, sf_dir):
    return substrings.digests(table(spark, sf_dir, "documents"))


@query("op10_sharding", f"""
WITH addressed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60, '0') AS address
  FROM documents),
prefixes AS (SELECT *, left(address, CAST(k AS INT)) AS shard FROM addressed, range(0, 61) r(k)),
sums AS (
  SELECT shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM prefixes GROUP BY shard
  HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1)
SELECT doc_id, 'b' || shard AS shard, shard_bytes, shard_rows, CAST(n_bytes AS BIGINT) AS n_bytes FROM prefixes JOIN sums USING (shard)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) = 1""")
def op10_sharding(spark, sf_dir):
    path = f"{work_dir(spark, 'shards')}/table"
    sharding.write_shards(table(spark, sf_dir, "documents"), path, SHARD_BYTES)
    return spark.read.parquet(path).select("doc_id", "shard", "shard_bytes", "shard_rows", "n_bytes")


@query("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_vector_codes", codes.sql())
def op12_vector_codes(spark, sf_dir):
    return codes.digests(table(spark, sf_dir, "embeddings"))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
