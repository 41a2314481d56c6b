"""Every operator and stage with nulls, empty and long texts, repeats, clashing and extra columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import (
    arrow_sequences,
    decontamination,
    language,
    licences,
    line_frequency,
    packing,
    quotations,
    sanitisation,
    sharding,
    simhash,
)

WORDS = " ".join(f"word{i % 97}x{i}" for i in range(60))
LONG = " ".join(f"w{i}" for i in range(30_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _hash string, "
    "text_hash string, bits string, host string, _terms string, `in_text` string, `a.b` int"
)
ROWS = [
    (1, WORDS, "en", "s", 5, *["x"] * 6, 1),
    (1, WORDS, "en", "s", 5, *["x"] * 6, 1),
    (2, WORDS, "en", None, None, *[None] * 6, None),
    (3, None, None, "s", None, *["y"] * 6, 2),
    (4, "", "de", "s", 0, *["y"] * 6, 2),
    (5, "!! ..", "de", "s", 0, *["y"] * 6, 2),
    (None, WORDS + " end", "en", "s", 0, *["y"] * 6, 2),
    (None, None, None, None, None, *[None] * 6, None),
    (6, LONG, "de", "s", 1, *["z"] * 6, 3),
    (7, "mail a@b.example.com now  ", "en", "t", 1, *["z"] * 6, 3),
]


@pytest.fixture(params=["odd", "empty"])
def docs(spark, request):
    return spark.createDataFrame(ROWS if request.param == "odd" else [], SCHEMA)


def items(spark):
    rows = [(1, WORDS), (2, None), (None, "short one"), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_row_operators_keep_every_row(spark, docs):
    n = docs.count()
    word, byte = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    assert packing.pack_documents(docs, word).where("piece = 0").count() == n
    assert simhash.near_duplicates(docs).count() == n
    assert sharding.with_slots(sharding.key_shards(docs, 5)).count() == n
    assert line_frequency.judge(docs).count() == n
    assert sanitisation.sanitised(docs).count() == n
    assert language.identify(docs, language.Training(steps=2)).count() == n
    folder = arrow_sequences.new_folder(docs)
    files = arrow_sequences.write_sequences(docs, folder, byte, 2, rows=3)
    back = arrow_sequences.read_documents(files, folder).collect()
    assert len(back) == n
    assert sorted((r["start"], r["n_tokens"]) for r in back)[0][0] == 0 if n else True
    licences.licences(docs).collect()


def test_stages_return_the_columns_of_documents(spark, docs, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in docs.schema
        ], name
        kept = out.select("_hash", "text_hash", "bits", "`a.b`", "in_text").collect()
        assert {tuple(r) for r in kept} <= {(r[5], r[6], r[7], r[11], r[10]) for r in ROWS}
    corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_one_row_of_each_group_stays(spark):
    out = simhash.one_per_group(spark.createDataFrame(ROWS, SCHEMA)).select("doc_id", "text")
    kept = [tuple(r) for r in out.collect()]
    assert kept.count((1, WORDS)) == 1 and (2, WORDS) not in kept
    # Texts without words are one group, of which the smallest id stays.
    assert (3, None) in kept and (4, "") not in kept and (None, None) not in kept


def test_defined_results_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    named = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(docs, language.Training(steps=2)).collect()}
    assert {(3, "und", 0.0), (4, "und", 0.0), (5, "und", 0.0)} <= named
    judged = {r["in_doc_id"]: r for r in line_frequency.judge(docs).collect()}
    assert judged[3]["n_words"] == 0 and judged[3]["base_failed"] and not judged[3]["kept"]
    assert judged[1]["kept"] and judged[6]["n_words"] == 30_000
    held = decontamination.contaminated(docs, items(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in held) == [(0, 1), (1, 1), (1, 1), (2, 1)]
    assert decontamination.contaminated(docs, items(spark).where("false")).count() == 0


def test_messages_with_nulls_and_repeats(spark):
    rows = [
        (1, 0, "hello there"), (1, 0, "hello there"), (1, 1, "> hello there\n>> deep\nyes"),
        (None, 1, "> hello there\nno"), (1, None, "> yes"), (2, 0, None), (3, 0, ""),
        (4, 5, "> HELLO  there\nfar"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("own", F.lit(1))
    out = {(r["conv_id"], r["turn"], r["own"]): r for r in quotations.reply_order(frame).collect()}
    assert len(out) == 7
    reply = out[(1, 1, "yes")]
    assert (reply["reply_conv"], reply["reply_turn"], reply["depth"], reply["n_passages"]) == (1, 0, 1, 2)
    assert out[(None, 1, "no")]["reply_conv"] is None and out[(1, None, "")]["depth"] == 0
    assert (out[(4, 5, "far")]["root_conv"], out[(4, 5, "far")]["depth"]) == (1, 1)
    assert quotations.reply_order(frame.where("false")).count() == 0
