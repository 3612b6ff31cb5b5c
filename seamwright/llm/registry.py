"""The opN_ queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import embedding_dedup, exact_dedup, html_text, langid, mixing, ngram_join, prefix_trie, resampling, secret_scan, sp_codec, substring_dedup, token_file, toxicity
from .common import table


def op1_mix(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_sentencepiece(spark, sf_dir):
    return sp_codec.round_trip(table(spark, sf_dir, "documents"))


def op4_token_file(spark, sf_dir):
    return token_file.read(token_file.write(table(spark, sf_dir, "documents"), token_file.default_path()))


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_secrets(spark, sf_dir):
    return secret_scan.find(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


#: Words of the shortest span that op9 reports: licence lines, headings and other short lines that clean documents share stay.
LEAST_RUN = 20


def op9_substring_dedup(spark, sf_dir):
    return substring_dedup.removals(table(spark, sf_dir, "documents"), least_run=LEAST_RUN).drop("a", "k")


def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.label_spans(docs, langid.trained(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))).drop("turn")


def op12_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op13_resampling(spark, sf_dir):
    return resampling.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_ngram_join": op2_ngram_join,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_file": op4_token_file,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language": op10_language,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_html_text": op12_html_text,
    "op13_resampling": op13_resampling,
}
ORACLES = {"op1_mix": mixing.ORACLE, "op2_ngram_join": ngram_join.ORACLE, "op5_embedding_dedup": embedding_dedup.ORACLE, "op8_exact_dedup": exact_dedup.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE, "op12_html_text": html_text.ORACLE, "op13_resampling": resampling.ORACLE}
