"""Registered queries of this subpackage (``queries``) and their SQL (``oracle_sql``)."""

from __future__ import annotations

import public_tokenizers

from branchbook.llm import (
    ann, bpe, dac, divergence, interaction, langid, licenses, minhash, op4_sql, packing, quality, secrets, substrings,
    urlfilter)
from branchbook.llm.common import Workspace, table


def op3_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), Workspace(spark, "op3"))


def op4_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), Workspace(spark, "op4"))


def op1_url_filter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "op2"))


def op5_substring_dedup(spark, sf_dir):
    return (substrings.remove_repeats(table(spark, sf_dir, "documents"), Workspace(spark, "op5"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        Workspace(spark, "op6"))


def op7_secret_scan(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), Workspace(spark, "op9"))


def op10_byte_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op11_filter_interaction(spark, sf_dir):
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark, "op11"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), Workspace(spark, "op12"))


def op13_direct_codes(spark, sf_dir):
    return dac.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      f"{Workspace(spark, 'op13').root}/tokens")


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_minhash_near_dedup, op3_nearest_neighbours, op4_quality_rules, op5_substring_dedup,
    op6_best_fit_packing, op7_secret_scan, op8_license_scan, op9_language_id, op10_byte_bpe,
    op11_filter_interaction, op12_source_divergence, op13_direct_codes)}
ORACLES = {"op1_url_filter": urlfilter.SQL, "op4_quality_rules": op4_sql.SQL,
           "op11_filter_interaction": interaction.SQL, "op12_source_divergence": divergence.SQL}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
