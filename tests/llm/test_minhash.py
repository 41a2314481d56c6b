"""Near-duplicates by sets of shingles against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import minhash
from martloom.llm.words import WordHashes


def plain(rows, percent=85, shingle=5):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        last = max(1, len(words) - shingle + 1)
        sets.append({b" ".join(words[i : i + shingle]) for i in range(last)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in ids[find(i)] if d is not None] if sets[i] else [doc_id]
        component = min(known) if known else None
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(map(repr, out))


def found(docs):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    return sorted(map(repr, map(tuple, minhash.near_duplicates(docs).select(*columns).collect())))


def near_copies(rng, groups, size, words):
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
                text[rng.randrange(words)] = f"new{rng.randrange(10**9)}"
            rows.append(" ".join(text[: rng.choice([words, words, words - 3])]))
    return rows


@pytest.mark.parametrize("words", [7, 60])
def test_groups_equal_all_pairs(spark, words):
    rng = random.Random(words)
    texts = near_copies(rng, 6, 25, words)
    texts += [f"{' '.join(f'c{i}' for i in range(n))}" for n in range(1, 13)] + texts[:9]
    rng.shuffle(texts)
    rows = [(i, t.title() if i % 3 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == plain(rows)


@pytest.mark.parametrize("centres,parts", [(2, 12)])
def test_no_link_is_lost_though_stars_meet_few_pairs(spark, monkeypatch, centres, parts):
    # A chain: each text links with its neighbours only, and all lie in the same crowded buckets.
    monkeypatch.setattr(minhash, "CENTRES", centres)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        words = [f"w{i}" for i in range(400)]
        rows = [(i, " ".join(words[3 * i : 3 * i + 120])) for i in range(60)]
        rows += [(100 + i, " ".join(words[150:270] + [f"x{i}y{k}" for k in range(8 + 3 * i)])) for i in range(20)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        assert found(docs) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_nulls_repeats_and_empty_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(30_000))
    rows = [(5, long), (4, long + " end"), (None, long), (7, None), (8, ""), (9, " \t\n"), (7, None),
            (1, "one two"), (2, "One  TWO"), (2, "One  TWO"), (None, "alone"), (3, "one two three four five")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, n int")
    assert found(docs) == plain(rows)
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_bins_agree_as_often_as_sets_overlap():
    words, rng = WordHashes(), random.Random(3)
    for n in (7, 40, 2000):
        share = []
        for _ in range(60 if n < 1000 else 6):
            base = [f"{rng.random()}" for _ in range(n + 4)]
            a = minhash.shingle_set(" ".join(base), words)
            b = np.sort(np.append(a, np.uint64(rng.getrandbits(64))))
            share.append(np.mean(minhash.signature(a) == minhash.signature(b)) - n / (n + 1))
        assert abs(np.mean(share)) < 0.03


def test_sketches_of_overlapping_sets_differ_in_few_bits():
    words, rng = WordHashes(), random.Random(9)
    limit, most, far = minhash.sketch_limit(85), 0, 0
    assert 45 < limit < 60
    for n in (6, 13, 100, 1500):
        for _ in range(60):
            base = [f"{rng.random()}" for _ in range(n + 4)]
            a = minhash.shingle_set(" ".join(base), words)
            cut = a[rng.sample(range(len(a)), int(np.ceil(0.85 * len(a))))]
            sides = [minhash.sketch(minhash.signature(np.sort(x))).view(np.uint64) for x in (a, cut)]
            most = max(most, int(np.bitwise_count(sides[0] ^ sides[1]).sum()))
            other = minhash.shingle_set(" ".join(f"{rng.random()}" for _ in range(n + 4)), words)
            bits = minhash.sketch(minhash.signature(other)).view(np.uint64)
            far += int(np.bitwise_count(sides[0] ^ bits).sum()) > limit
    assert most <= limit and far == 240


def test_lenders_are_the_same_one_by_one_and_at_once():
    rng = np.random.default_rng(1)
    for n in (5, 31, 32, 33, 200):
        hashes = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        one = minhash.signature(hashes)
        few, minhash._FEW = minhash._FEW, 0 if n < minhash._FEW else 1000
        try:
            assert (minhash.signature(hashes) == one).all()
        finally:
            minhash._FEW = few


def test_a_hot_bucket_lies_in_many_tasks(spark):
    rows = spark.range(5000).select(
        F.array(F.lit(7), (F.col("id") % 2500) + 1000).alias("keys"), F.col("id").alias("node"), F.lit(9).cast("long").alias("n")
    )
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shared = minhash.shared_buckets(rows)
        hot = shared.where("key = 7")
        assert hot.select("node").distinct().count() == 5000
        edges = minhash.ordered_pairs(hot, "node", "centre").collect()
        assert len(edges) < 5016 and len({r["a"] for r in edges}) > 1
        pairs = shared.where("key <> 7 and node <> centre")
        assert pairs.count() == 2500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_near_copies_and_almost_near_ones_are_compared_few_times(spark, monkeypatch):
    rng, compared, met = random.Random(3), [], []
    confirmed, ordered = minhash.confirmed, minhash.ordered_pairs

    def counting(pairs, sets, percent):
        compared.append(pairs.count())
        return confirmed(pairs, sets, percent)

    def listing(pairs, a, b):
        out = ordered(pairs, a, b)
        met.append((pairs.count(), out.count()))
        return out

    monkeypatch.setattr(minhash, "confirmed", counting)
    monkeypatch.setattr(minhash, "ordered_pairs", listing)
    copies = [" ".join([f"a{i}" for i in range(400)] + [f"b{k}"]) for k in range(40)]
    # Each has a quarter of its words apart, so that many buckets are shared and no two link.
    base = [f"c{i}" for i in range(600)]
    almost = [" ".join(base + [f"d{k}e{rng.randrange(10**9)}" for _ in range(90)]) for k in range(12)]
    rows = list(enumerate(copies + almost))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == plain(rows)
    # Each copy meets one centre, the others meet those they are not linked with.
    assert compared[0] < len(rows) and sum(compared) < 40 + 12 * 12
    # A pair comes at most once from either side, whatever the buckets it shares.
    assert met and all(n <= 2 * pairs for n, pairs in met)


@pytest.mark.parametrize("block", [7, 256])
def test_crowded_buckets_are_compared_inside_tasks(spark, monkeypatch, block):
    rng, met = random.Random(5), []
    ordered, made = minhash.ordered_pairs, minhash.block_links

    def listing(pairs, a, b):
        met.append(pairs.count())
        return ordered(pairs, a, b)

    def links(rows, facts, percent):
        out = made(rows, facts, percent)
        # Two groups of a block are linked once, however many of their members are near.
        assert out.count() <= rows.select("i", "j", "key").distinct().count() * 60
        return out

    monkeypatch.setattr(minhash, "ordered_pairs", listing)
    monkeypatch.setattr(minhash, "block_links", links)
    monkeypatch.setattr(minhash, "CROWDED", 0)
    monkeypatch.setattr(minhash, "BLOCK", block)
    # 40 texts that share most buckets and do not link, and a chain whose neighbours alone do.
    base, words = [f"c{i}" for i in range(200)], [f"w{i}" for i in range(400)]
    texts = [" ".join(base + [f"d{k}e{rng.randrange(10**9)}" for _ in range(30)]) for k in range(40)]
    texts += [" ".join(words[3 * i : 3 * i + 120]) for i in range(40)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(docs) == plain(rows)
    # Pairs that share a crowded bucket are no rows: there are 780 of the first kind alone.
    assert met and not any(met)
