"""Quality rules by cross-document line frequency, and the counts of words they start from.

A line that many documents of one host share is boilerplate (menus, notices): such lines are
removed, and a document that is little more than such lines is rejected. Documents are counted by
text, so copies of one document do not make its lines frequent. The first text (smallest doc_id)
that has a frequent line keeps it, so no sentence leaves the corpus altogether.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import (
    BROADCAST_ROWS,
    HOT_PARTS,
    HOT_ROWS,
    framed,
    many_to_one,
    stored,
    unframed,
    whole_text,
)

SPACE = r"[\x20\x09-\x0D]+"
# Lines of so few words repeat by chance, and need more texts to count as boilerplate by number alone.
SHORT_WORDS = 3
# Hashes of lost lines that are broadcast at most: 8 MB.
LOST_BROADCAST = 1_000_000


@dataclass(frozen=True)
class Limits:
    """A line is frequent on a host if ``many_docs`` of its texts have it (``many_docs_short`` for
    lines of one to three words), however large the host; or if at least ``line_docs`` texts and
    more than ``line_percent`` percent of the host's texts have it. A document is depleted if fewer than ``min_words`` words
    or less than ``min_left_percent`` percent of its words are left."""

    line_docs: int = 10
    line_percent: int = 5
    many_docs: int = 50
    many_docs_short: int = 500
    min_words: int = 50
    min_left_percent: int = 50
    max_repeat_percent: int = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def normal_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def _at(array: Column, index: Column) -> Column:
    return F.get(array, index)


def repeated_words(grams: Column, n: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more; ``grams`` are their hashes."""
    # Sorted (hash, place): equal neighbours are windows found more than once.
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(pairs: Column) -> Column:
        return F.filter(
            pairs,
            lambda p, k: F.coalesce(p["h"] == _at(pairs, k + 1)["h"], F.lit(False))
            | F.when(k > 0, p["h"] == _at(pairs, k - 1)["h"]).otherwise(False),
        )

    places = F.sort_array(F.transform(twins(F.col("_pairs")), lambda p: p["i"]))
    return pairs, places


def with_counts(docs: DataFrame) -> DataFrame:
    """Adds _words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and _lines.

    ``_text`` must hold the whole text. Everything is evaluated in place, without a shuffle.
    """
    cut = docs.withColumns(
        {
            "_words": words_of(F.col("_text")),
            "_lines": F.split("_text", "\n"),
        }
    )
    counted = cut.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter("_lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_full"),
        F.slice(
            F.transform(
                "_words",
                lambda w, i: F.xxhash64(w, _at(F.col("_words"), i + 1), _at(F.col("_words"), i + 2)),
            ),
            1,
            F.greatest(F.size("_words") - 2, F.lit(0)),
        ).alias("_grams"),
    )
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    pairs, places = repeated_words(F.col("_grams"), F.col("n_words"))
    sorted_pairs = counted.select(
        "*",
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, pairs).alias("_pairs"),
    ).drop("_grams", "_full")
    found = sorted_pairs.withColumn(
        "_places", F.when(F.col("_pairs").isNotNull(), places)
    ).drop("_pairs")
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, k: F.least(F.coalesce(_at(F.col("_places"), k + 1) - p, F.lit(3)), F.lit(3)),
        ),
        F.lit(0),
        lambda total, step: total + step,
    )
    return found.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")
    ).drop("_places", "_words")


def host_lines(docs: DataFrame) -> DataFrame:
    """One row per line of each different text of a host: host, line (hash), text_hash, short, doc_id.

    Columns read: host, doc_id, text_hash, _text. Copies of a text collapse before the shuffle; a
    line is short if it has at most SHORT_WORDS words.
    """
    full = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lines = F.transform(
        F.transform(full, normal_line),
        lambda norm: F.struct(
            F.xxhash64(norm).alias("line"),
            (F.length(norm) - F.length(F.replace(norm, F.lit(" "))) < SHORT_WORDS).alias("short"),
        ),
    )
    rows = docs.select("host", "doc_id", "text_hash", F.inline(lines))
    return rows.groupBy("host", "line", "text_hash").agg(
        F.first("short").alias("short"), F.min("doc_id").alias("doc_id")
    )


def frequent_lines(docs: DataFrame, lines: DataFrame, limits: Limits) -> DataFrame:
    """host, line, n (texts that have it), first (the text that may keep it) of frequent lines.

    ``lines`` are those of ``host_lines``. They are counted with partial sums, so neither a large
    host nor a common line meets in one task.
    """
    counted = lines.groupBy("host", "line").agg(
        F.count("*").alias("n"),
        F.first("short").alias("short"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))["text_hash"].alias("first"),
    )
    texts = docs.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    many = F.when(F.col("short"), limits.many_docs_short).otherwise(limits.many_docs)
    often = counted.where(F.col("n") >= min(limits.line_docs, limits.many_docs, limits.many_docs_short))
    often = often.join(texts, "host").where(
        (F.col("n") >= many)
        | (F.col("n") >= limits.line_docs) & (F.col("n") * 100 > F.col("texts") * limits.line_percent)
    )
    return often.select("host", "line", "n", "first")


def lost_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """host, text_hash, lost: the hashes of the frequent lines that each text has to give up.

    A group holds the lines of one text. Lines of many texts are met by broadcast, others by shuffle.
    """
    size, rows = frequent.agg(F.count("*"), F.sum("n")).first()
    if size <= BROADCAST_ROWS:
        met = lines.join(F.broadcast(frequent), ["host", "line"])
    else:
        met = many_to_one(lines, frequent, ["host", "line"], rows)
    given_up = met.where(F.col("first") != F.col("text_hash"))
    return given_up.groupBy("host", "text_hash").agg(F.collect_list("line").alias("lost"))


def with_lost(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """Adds ``lost`` to each row: broadcast if there are few lines, else joined by text.

    Texts with many copies, at most HOT_PARTS of them, are met by broadcast in any case, and their
    rows take no part in the join of the others: each is shuffled by a key of its own.
    """
    keys = ["host", "text_hash"]
    if (lost.agg(F.sum(F.size("lost"))).first()[0] or 0) <= LOST_BROADCAST:
        return docs.join(F.broadcast(lost), keys, "left")
    copies = stored(docs.groupBy(*keys).count())
    rows = copies.agg(F.sum("count")).first()[0]
    hot = copies.where(F.col("count") > max(HOT_ROWS, rows // HOT_PARTS))
    hot = hot.join(lost, keys, "left").select(
        *keys, F.coalesce("lost", F.array().cast("array<bigint>")).alias("_hot_lost")
    )
    dealt = docs.join(F.broadcast(hot), keys, "left").withColumns(
        {
            "_cold": F.col("_hot_lost").isNull(),
            "_key": F.when(F.col("_hot_lost").isNull(), F.col("text_hash")).otherwise(
                F.xxhash64("doc_id", F.monotonically_increasing_id())
            ),
        }
    )
    side = lost.select("host", F.col("text_hash").alias("_key"), "lost", F.lit(True).alias("_cold"))
    met = dealt.join(side, ["host", "_key", "_cold"], "left")
    return met.withColumn("lost", F.coalesce("_hot_lost", "lost")).drop("_hot_lost", "_key", "_cold")


def judge(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Every row of the documents with its counts, its verdict and the text without frequent lines.

    Output: all columns of ``docs`` (prefixed ``in_``), then n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_frequent_lines, n_words_left, kept, clean_text.
    A null text has no words and fails; a null host is a host of its own; repeated rows stay and
    get the same verdict; null ids come last when the text that keeps a line is chosen.
    """
    given = framed(docs)
    rows = given.withColumns(
        {
            "host": F.coalesce(F.concat(F.lit("="), F.col(f"in_{host}")), F.lit("")),
            "doc_id": F.col("in_doc_id"),
            "_text": whole_text("in_text"),
            "text_hash": F.xxhash64("in_text"),
        }
    )
    keyed = rows.select("host", "doc_id", "text_hash", "_text")
    lines = stored(host_lines(keyed))
    frequent = stored(frequent_lines(keyed, lines, limits))
    lost = stored(lost_lines(lines, frequent))
    counted = with_counts(with_lost(rows, lost))
    # The lines this text has to give up.
    split = counted.withColumn("_lost", F.coalesce("lost", F.array().cast("array<bigint>")))
    left = F.when(F.size("_lost") == 0, F.col("_lines")).otherwise(
        F.filter(
            "_lines", lambda line: ~F.array_contains(F.col("_lost"), F.xxhash64(normal_line(line)))
        )
    )
    split = split.withColumn("_left", left)
    clean = split.withColumn(
        "clean_text",
        F.when(F.size("_left") == F.size("_lines"), F.col("_text")).otherwise(
            F.array_join("_left", "\n")
        ),
    )
    n_left = F.when(F.size("_left") == F.size("_lines"), F.col("n_words")).otherwise(
        F.size(words_of(F.col("clean_text"))).cast("long")
    )
    failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent
    )
    judged = clean.withColumns(
        {
            "base_failed": failed,
            "n_frequent_lines": (F.size("_lines") - F.size("_left")).cast("long"),
            "n_words_left": n_left,
        }
    )
    depleted = (F.col("n_words_left") < limits.min_words) | (
        F.col("n_words_left") * 100 < F.col("n_words") * limits.min_left_percent
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).select(
        *[F.col(f"`{c}`") for c in given.columns],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_frequent_lines", "n_words_left", "kept", "clean_text",
    )


def keep_good(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The documents that pass, with frequent lines removed and ``n_chars`` counted anew if there."""
    # Stored before the filter, which else is pushed down and evaluates all counts twice.
    judged = judge(docs, limits, host).drop("in_text")
    judged = stored(judged, compression="zstd").where("kept")
    return unframed(
        judged, docs, text=F.col("clean_text"), n_chars=F.length("clean_text").cast("long")
    )
