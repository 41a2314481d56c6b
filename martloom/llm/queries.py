"""Registered queries of the operators, over whole tables; the operators give the real outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    alignment,
    arrow_sequences,
    collocations,
    decontamination,
    language,
    licences,
    line_frequency,
    minhash,
    packing,
    quotations,
    sanitisation,
    sharding,
    simhash,
)
from martloom.llm.common import read, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS = 40


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read(spark, sf_dir, "documents"), path)


@query
def op9_jump_sharding(spark, sf_dir):
    rows = stored(sharding.key_shards(read(spark, sf_dir, "documents"), SHARDS))
    return sharding.with_slots(rows).withColumn("law", F.lit("key"))


@query
def op10_simhash_near_dup(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op2_line_frequency(spark, sf_dir):
    judged = line_frequency.judge(read(spark, sf_dir, "documents"))
    return judged.select(
        F.col("in_doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_frequent_lines", "n_words_left",
    )


@query
def op3_template_decontamination(spark, sf_dir):
    return decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


@query
def op6_information_pii(spark, sf_dir):
    done = sanitisation.sanitised(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in sanitisation.KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*sanitisation.KINDS))
    return done.select(
        F.col("in_doc_id").alias("doc_id"),
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op4_arrow_sequences(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    folder, path = arrow_sequences.new_folder(docs), public_tokenizers.path("byte_bpe_50k.json")
    files = arrow_sequences.write_sequences(docs, folder, path, end_id=2)
    back = arrow_sequences.read_documents(files, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_licence_sentences(spark, sf_dir):
    return licences.licences(read(spark, sf_dir, "documents"))


@query
def op5_quotation_linking(spark, sf_dir):
    # The turns hold no quotes of their own; as mails, each quotes the turns before it.
    mails = quotations.as_mail(read(spark, sf_dir, "conversations"))
    ordered = quotations.reply_order(mails)
    reply_to = F.concat_ws(":", "reply_conv", "reply_turn")
    return ordered.select(
        "conv_id", "turn", "n_passages", "n_linked",
        F.when(F.col("reply_conv").isNotNull(), reply_to).alias("reply_to"),
        "root_conv", "root_turn", "depth", F.md5("own").alias("own_md5"),
    )


@query
def op7_byte_network_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs).withColumn("held_out", language.held_out())


@query
def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query
def op12_token_alignment(spark, sf_dir):
    byte_path = public_tokenizers.path("byte_bpe_50k.json")
    piece_path = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignments(read(spark, sf_dir, "documents"), byte_path, piece_path)


@query
def op13_minhash_near_dup(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))
