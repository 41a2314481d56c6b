"""Items that are held with a changed slot, in parts, or that consist of numbers mostly."""

import pytest

from martloom.llm import decontamination

LETTERS = "abcdefghijklmnopqrstuvwxyz"
WORDS = [f"{a}{b}{c}" for a in LETTERS[:6] for b in LETTERS[6:12] for c in LETTERS[12:18]]
LONG = " ".join(f"{w} 7" if k % 9 == 0 else w for k, w in enumerate(WORDS[:200]))
SUM = "What is 12 + 7 * 3?"
FRUIT = "the old farmer sells 5 apples and 7 pears to every one of his good friends today"
TWO = "the first of them has Two red balls and after a while has two blue ones as well"


def found(spark, item, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = decontamination.contaminated(docs, benchmark).collect()
    return {r["doc_id"]: (r["n_found"], r["n_windows"]) for r in rows}


def test_one_changed_slot_does_not_clear_a_copy(spark):
    at = LONG.rindex(" 7 ")
    copy = LONG[:at] + " 8 " + LONG[at + 3 :]
    assert set(found(spark, LONG, copy, LONG.replace("7", "9"))) == {0, 1}


def test_equal_words_in_a_long_run_are_never_cleared(spark):
    # Each slot of the second half has another value: the diagonal disagrees, 100 words are equal.
    half = LONG.split(" ")
    other = [f"1{k}" if w == "7" and k > 100 else w for k, w in enumerate(half)]
    assert set(found(spark, LONG, " ".join(other))) == {0}


def test_different_values_may_become_equal(spark):
    same = FRUIT.replace("5", "3").replace("7", "3")
    assert set(found(spark, FRUIT, same)) == {0}


def test_values_are_compared_in_small_letters(spark):
    assert set(found(spark, TWO, TWO.lower())) == {0}


@pytest.mark.parametrize("item", [SUM, "1 2 3 5 8 13 21 34 55 89", "x 1 2 3 y 4 5 6 z 7 8 9"])
def test_items_of_numbers_are_found_as_they_are(spark, item):
    other = item.replace("3", "4")
    assert found(spark, item, f"Before. {item} After.", other)[0][0] > 0
    assert 1 not in found(spark, item, item, other)


def test_a_long_passage_counts_whatever_its_share(spark):
    words = LONG.split(" ")
    got = found(spark, LONG, " ".join(words[50:100]), " ".join(words[50:62]), " ".join(words[50:100]).replace("7", "4"))
    assert set(got) == {0, 2} and got[0][0] * 100 < got[0][1] * decontamination.MIN_SHARE_PERCENT


LEAD = " ".join(WORDS[:18])


def own_words(k, n=12):
    return " ".join(f"{w}{LETTERS[k % 26]}{LETTERS[k // 26]}" for w in WORDS[40 : 40 + n])


def pairs(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r) for r in decontamination.contaminated(docs, benchmark).select("doc_id", "item_id").collect()}


def test_a_lead_in_of_many_items_finds_none_of_them(spark):
    items = [(k, f"{LEAD} {own_words(k)}") for k in range(60)]
    only_lead = [f"{own_words(500 + k, 30)} {LEAD} {own_words(600 + k, 30)}" for k in range(40)]
    assert pairs(spark, items, only_lead) == set()
    whole = [f"some more {text} some more" for _, text in items]
    assert pairs(spark, items, whole + only_lead) == {(k, k) for k in range(60)}


def test_hits_grow_with_the_texts_not_with_the_items_that_share_windows(spark):
    texts = [f"{own_words(500 + k, 30)} {LEAD}" for k in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "text_hash long, _text string")
    for n in (20, 60):
        benchmark = spark.createDataFrame(
            [(k, f"{LEAD} {own_words(k)}") for k in range(n)], "item_id long, text string"
        )
        items = decontamination.weighed(decontamination.item_windows(benchmark))
        assert decontamination.met_windows(docs, items).count() == 40 * (18 - decontamination.WINDOW + 1)
        assert decontamination.hits(docs, items).count() == 0


def test_items_without_windows_of_their_own_are_found_by_their_rarest(spark):
    items = [(k, f"{LEAD} {own_words(k)}") for k in range(30)] + [(100, LEAD), (101, LEAD), (None, LEAD)]
    assert pairs(spark, items, [f"before {LEAD} after"]) == {(0, 100), (0, 101), (0, None)}


def test_items_of_one_template_are_all_found(spark):
    items = [(k, f"how many red apples does the farmer sell in {k + 3} days at {k + 90} each") for k in range(25)]
    assert pairs(spark, items, [items[4][1].replace("7", "55"), "how many red apples are there"]) == {
        (0, k) for k in range(25)
    }
