"""Operators against plain versions that look at every pair, window or bin."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm import (
    arrow_sequences,
    decontamination,
    language,
    line_frequency,
    packing,
    sanitisation,
    sharding,
    simhash,
)
from martloom.llm.common import read
from martloom.llm.queries import QUERIES
from martloom.llm.tokens import ENTRY_BYTES, Cache, Encoder

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n", "  a b", "a  b", "a\n\nb", "a \nb", "tab\tx", "x\x1cy z", "it's I'LL 'sx",
       "12 345 ½ x²", "<|endoftext|> hi", "alpha <|endoftext|> beta", "x<|StartOfText|>y", "<| <|endoftext|>\n", "a b ", "日本語 テキスト", "ΣΑΣ", "A-b_c's 'tis", "x \x00y",
       "\x85 a\x85b", "é é ÇA"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = read(spark, SF, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_those_of_the_library(texts, name):
    path = public_tokenizers.path(name)
    for plain in (False, True):
        library, mine = Tokenizer.from_file(path), Encoder(path, plain)
        if plain:
            library.encode_special_tokens = True
        for text in [*ODD, *list(texts.values())[:100]]:
            assert mine.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_caches_hold_bytes_not_entries():
    made = []
    cache = Cache(lambda p: made.append(p) or p.encode(), most=10 * (ENTRY_BYTES + 20))
    for i in range(200):
        cache.one(b"%010d" % i)
        assert cache.held <= cache.most and len(cache.young) + len(cache.old) <= 20
    long = b"x" * 5000
    assert cache.one(long) == cache.one(long) == long and made.count(long.decode()) == 2


def test_packing_digest_and_layout(spark, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc_id, text in texts.items():
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want[(doc_id, k)] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    sequences = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 2048
    assert len(sequences) <= 1.05 * sum(r["length"] for r in rows) / 2048 + 1


def test_each_piece_goes_where_the_sum_of_squares_is_least():
    rng, capacity = random.Random(4), 12
    mine, counts = packing.OpenSequences(capacity), {}
    for _ in range(400):
        n = rng.randint(1, capacity)
        costs = {}
        for gap in [capacity, *[g for g, c in counts.items() if c and g >= n]]:
            after = dict(counts)
            if gap < capacity or counts.get(gap):
                after[gap] = after.get(gap, 0) - (gap < capacity)
            if gap > n:
                after[gap - n] = after.get(gap - n, 0) + 1
            costs[gap] = min(costs.get(gap, 1 << 60), sum(c * c for c in after.values()))
        _, offset = mine.place(n)
        gap = capacity - offset
        assert costs[gap] == min(costs.values())
        if gap < capacity:
            counts[gap] -= 1
        if gap > n:
            counts[gap - n] = counts.get(gap - n, 0) + 1


def test_arrow_files_round_trip(spark, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, at = sorted(tuple(r) for r in QUERIES["op4_arrow_sequences"](spark, SF).collect()), 0
    for (doc_id, text), row in zip(sorted(texts.items()), rows, strict=True):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert row == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_sequences_are_read_in_place(spark, tmp_path):
    from pyarrow import fs

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, "a b c d e f g " * i) for i in range(200)], "doc_id long, text string")
    files = arrow_sequences.write_sequences(docs, str(tmp_path), path, 2, length=16, rows=10_000)
    shard = arrow_sequences.ShardReader(fs.LocalFileSystem(), f"{tmp_path}/{files.first()['file']}")
    total = files.first()["n_tokens"]
    stream = shard.ids(0, total)
    for i in (0, 5, 64, 100, total // 16):
        ids, mask = shard.sequence(i)
        held = np.array(mask.to_pylist())
        assert len(ids) == 16 and not ids.flags.owndata
        assert ids[held].tolist() == stream[i * 16 : (i + 1) * 16].tolist()


def near_groups(prints, radius):
    prints = np.array(prints, np.uint64)
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= radius):
            a, b = sorted((find(i), find(int(j))))
            group[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_query(spark, texts):
    ids, prints = sorted(texts), []
    for doc_id in ids:
        small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[doc_id])
        words = re.findall(r"[^\x20\x09-\x0D]+", small)
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    want = {d: (f"{p:016x}", ids[g]) for d, p, g in zip(ids, prints, near_groups(prints, 4), strict=True)}
    rows = QUERIES["op10_simhash_near_dup"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("limit", [8192, 150])
def test_no_link_is_lost_in_crowded_groups(spark, limit):
    rng, prints = random.Random(3), set()
    centres = [rng.getrandbits(64) for _ in range(4)]
    for _ in range(1200):
        near = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            near ^= 1 << rng.randrange(64)
        prints.add(near)
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(500)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "bits long")
    found = simhash.components(simhash.links(frame, 4, limit)).collect()
    root = {r["node"]: r["root"] for r in found}
    mine, want = {}, {}
    for s, g in zip(signed, near_groups(prints, 4), strict=True):
        mine.setdefault(root.get(s, s), set()).add(s)
        want.setdefault(g, set()).add(s)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_jump_hash_moves_keys_only_into_the_new_shard(spark):
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    before, after = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    moved = before != after
    assert set(after[moved]) == {40} and 0.015 < moved.mean() < 0.035
    assert np.bincount(before, minlength=40).min() > 400

    def plain(key, shards):
        state, b, j = key % (1 << 64), -1, 0
        while j < shards:
            b = j
            state = (state * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * ((1 << 31) / ((state >> 33) + 1)))
        return b

    assert before[:500].tolist() == [plain(int(k), 40) for k in keys[:500]]


def test_slots_are_gapless_though_one_shard_holds_a_third(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("shard"))
    from martloom.llm.common import stored

    out = sharding.with_slots(stored(rows), rows=100).groupBy("shard").agg(F.sort_array(F.collect_list("slot")))
    for _, slots in out.collect():
        assert slots == list(range(len(slots)))


def test_personal_data_by_pattern(spark):
    def luhn(digits):
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    def plain(t):
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        spans += [
            ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))
        ]
        spans += [
            ("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))
        ]
        return spans + [
            ("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 8 <= len(digits(m)) <= 15
        ]

    rng = random.Random(1)
    for k in range(20_000):
        alphabet = "0123456789 -." if k % 3 == 0 else "aZ0.1@-+ _()\n9é4%"
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert sanitisation.base_spans(text) == plain(text)


FILLER = "common words of all the people who say what is here wrote from to any address without"


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"{FILLER} number{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(300)]
    filler = list(rows)
    rows += [(1000, "Zephyrine wrote from zoe@x.example.com to all people")] * 2
    rows += [(1001, "the people say zoe@x.example.com is Zephyrine of all")]
    rows += [(1002, "Quixotry wrote from max@x.example.com to people")] * 3
    # A telling term is treated wherever it stands, far from the address and in texts without it.
    rows += [(1003, "Zephyrine without any address of people")]
    rows += [(1004, "eve@x.example.com " + "people of the " * 40 + "Farawayville")]
    # As many texts without the entity leave a term deniable.
    rows += [(1005, "Commoner wrote to ann@x.example.com"), (1006, "Commoner wrote to all people")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in sanitisation.without_personal_data(docs).collect()}
    assert out[1000] == " wrote from [email] to all people"
    assert out[1001] == "the people say [email] is  of all"
    assert out[1002] == " wrote from [email] to people"
    assert out[1003] == " without any address of people"
    assert out[1004] == "[email] " + "people of the " * 40
    assert out[1005] == "Commoner wrote to [email]" and out[1006] == "Commoner wrote to all people"
    assert all(out[i] == t for i, t in filler)


def plain_sanitised(texts, how):
    """Treated words by text: every entity with every word, counted text by text."""
    word = re.compile(r"[^\x00-@\[-`{-\u00bf\u2000-\u206f\u3000-\u303f]+")
    unique, holds, outside, entities = set(texts), {}, {}, {}
    for t in unique:
        spans = sanitisation.base_spans(t)
        holds[t] = {w.lower() for w in word.findall(t)}
        outside[t] = {
            m.group().lower() for m in word.finditer(t)
            if all(m.end() <= a or m.start() >= b for _, a, b in spans)
        }
        for kind, a, b in spans:
            value = t[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", t[a:b])
            entities.setdefault((kind, value), set()).add(t)
    n, shares = len(unique), {}
    for held in entities.values():
        for w in set().union(*(outside[t] for t in held)):
            n_ct, n_t = sum(w in outside[t] for t in held), sum(w in h for h in holds.values())
            p, bits = (n_ct + len(held) / n) / (n_t + 1), np.log2(n / len(held))
            share = np.log2(p * n / len(held)) / bits if bits > 0 else 0
            if p >= how.certainty and share >= how.generalise:
                shares[w] = max(share, shares.get(w, 0))
    return {t: {w: shares[w] for w in holds[t] if w in shares} for t in unique}


@pytest.mark.parametrize("how", [sanitisation.Disclosure(), sanitisation.Disclosure(0.3, 0.7, 0.2, 3, 50)])
def test_spans_of_terms_equal_those_of_plain_counts(spark, how):
    rng = random.Random(7)
    names = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    rows = []
    for i in range(150):
        words = [rng.choice(names[: 8 if rng.random() < 0.7 else 80]) for _ in range(rng.randint(1, 25))]
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["me@x.example", "10.0.0.7", f"u{i % 9}@y.example"]))
        rows.append((i, " ".join(words).title() if i % 2 else " ".join(words)))
    rows += rows[:20] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_sanitised([t or "" for _, t in rows], how)
    word = re.compile(r"[^\x00-@\[-`{-\u00bf\u2000-\u206f\u3000-\u303f]+")
    texts, added = dict(rows), 0
    for r in sanitisation.sanitised(docs, how).collect():
        text = texts[r["in_doc_id"]] or ""
        base = sanitisation.base_spans(text)
        expected = [
            ("removed" if want[text][m.group().lower()] >= how.remove else "generalised", *m.span())
            for m in word.finditer(text)
            if m.group().lower() in want[text] and all(m.end() <= a or m.start() >= b for _, a, b in base)
        ]
        assert [tuple(s) for s in r["spans"]] == base + sorted(expected)
        added += len(expected)
    assert added > 10


def test_a_worker_holds_little_though_half_of_the_texts_share_addresses(spark):
    rng = random.Random(5)
    base = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(380)]
    rows = [
        (i, " ".join([*rng.sample(base, 370), *(f"user{k}@mail.example.com" for k in range(12))]))
        for i in range(3000)
    ]
    rows += [(10_000 + i, "plain text of other people") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def peak(batches):
        import resource

        import pyarrow as pa

        for batch in sanitisation._apply(batches):
            yield pa.RecordBatch.from_pydict(
                {"mb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024] * batch.num_rows}
            )

    words = spark.createDataFrame([(base, base[:0])], "_removed array<string>, _generalised array<string>")
    given = docs.select(F.col("text").alias("in_text")).crossJoin(F.broadcast(words))
    assert given.mapInArrow(peak, "mb long").agg(F.max("mb")).first()[0] < 400


def test_templates_find_reparameterised_items_only(spark):
    item = "On Monday Tom bought 5 apples and 12 pears for 20 dollars, and later Tom sold 5 apples to his aunt Ann."
    same = item.replace("Tom", "Bob").replace("5 ", "17 ").replace("20", "3.5").replace("Ann", "Eve")
    mixed = item.replace("sold 5", "sold 6").replace("later Tom", "later Bob")
    docs = spark.createDataFrame(
        [(1, item), (2, "Before. " + same + " After."), (3, mixed), (4, "Tom bought 5 apples and left for good.")],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontamination.contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 7), (2, 7)]
    kept = decontamination.without_contaminated(docs, benchmark).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 4]


def test_decontamination_finds_every_exact_passage(spark, texts):
    items = {r["item_id"]: r["text"] for r in read(spark, SF, "benchmark").collect()}
    exact = {(d, i) for d, t in texts.items() for i, passage in items.items() if passage in t}
    rows = QUERIES["op3_template_decontamination"](spark, SF).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert exact and exact <= found and {d for d, _ in found} == {d for d, _ in exact}


def test_frequent_lines_leave_one_text_and_deplete_others(spark):
    words = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, f"Menu  HOME about\n{words(i, 60)}", "a") for i in range(12)]
    rows += [(100 + i, "Menu home about\n" + words(i, 60), "b") for i in range(5)]
    rows += [(200, "menu home about " * 1 + "\n" + words(200, 49), "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["in_doc_id"]: r for r in line_frequency.judge(docs).collect()}
    assert out[0]["clean_text"] == rows[0][1] and out[0]["n_frequent_lines"] == 0
    assert out[1]["clean_text"] == words(1, 60) and out[1]["kept"]
    assert out[100]["n_frequent_lines"] == 0
    assert not out[200]["base_failed"] and not out[200]["kept"] and out[200]["n_words_left"] == 49


def test_a_notice_in_many_texts_goes_however_large_the_host(spark):
    notice = "This notice of thirteen words stands below fifty of the texts of us"
    rows = []
    for i in range(1200):
        body = " ".join(f"w{i}x{k}" for k in range(60))
        rows.append((i, body + ("\n" + notice if i < 50 else "\nnext page" if i < 110 else ""), "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["in_doc_id"]: r["n_frequent_lines"] for r in line_frequency.judge(docs).collect()}
    # The first text keeps the notice; 60 texts of 1,200 are 5 %, not more, and two words are few.
    assert {i for i, n in out.items() if n} == set(range(1, 50)) and max(out.values()) == 1


@pytest.mark.parametrize("lost_most, lines_most", [(0, 100_000), (0, 0)])
def test_lines_are_lost_alike_however_they_are_joined(spark, monkeypatch, lost_most, lines_most):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"menu home about us\n{body(i % 40)}", "ab"[i % 2]) for i in range(80)]
    rows += [(None, f"menu home about us\n{body(0)}", "a")] * 90 + [(900 + i, body(900), None) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(repr, line_frequency.judge(docs).collect()))
    monkeypatch.setattr(line_frequency, "LOST_BROADCAST", lost_most)
    monkeypatch.setattr(line_frequency, "BROADCAST_ROWS", lines_most)
    assert sorted(map(repr, line_frequency.judge(docs).collect())) == want
    assert any("n_frequent_lines=1" in row for row in want)


def test_language_gradients_and_held_out_accuracy(spark):
    net = language.new_network(["a", "b", "c"], 3, 1)
    rows, labels = np.random.default_rng(0).integers(0, 6, (5, 4)), np.array([0, 1, 2, 1])
    _, grads = language.gradients(net, rows, labels)
    for a, g in zip(net.arrays(), grads, strict=True):
        for k in np.argsort(-abs(g), axis=None)[:3]:
            at, step = np.unravel_index(k, a.shape), 1e-2
            held = a[at]
            a[at] = held + step
            up = language.gradients(net, rows, labels)[0]
            a[at] = held - step
            down = language.gradients(net, rows, labels)[0]
            a[at] = held
            assert (up - down) / (2 * step) == pytest.approx(g[at], abs=3e-4)
    docs = read(spark, SF, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = QUERIES["op7_byte_network_language"](spark, SF).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert [r for r in out if r["held_out"]] == held and len(out) == len(truth)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_predictions_equal_a_plain_loop_over_bytes(spark):
    net = language.new_network(["a", "b", "c"], 3, 5)
    texts = ["short", "a longer text, é and ü " * 9, "² ½ ① 12", "x" * 96, "y" * 97, None, "日本"]

    def plain(data, window=96):
        total = np.zeros(3)
        for at in range(0, len(data), window):
            # The last window is filled with zero bytes, which the backward direction reads first.
            part, states = data[at : at + window].ljust(window, b"\0"), []
            for d, order in ((0, part), (1, part[::-1])):
                h, kept = np.zeros(3), []
                for byte in order:
                    a = net.inputs[d][byte] + h @ net.states[d]
                    z, c = 1 / (1 + np.exp(-a[:3])), np.tanh(a[3:])
                    h = z * h + (1 - z) * c
                    kept.append(h)
                states.append(kept if d == 0 else kept[::-1])
            for forward, backward in list(zip(*states))[: len(data) - at]:
                scores = forward @ net.outputs[0] + backward @ net.outputs[1] + net.bias
                total += np.exp(scores) / np.exp(scores).sum()
        return total / len(data)

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language.predict(frame, net).collect():
        text = texts[r["doc_id"]]
        if r["doc_id"] in (2, 5):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            p = plain(text.encode())
            assert r["lang_pred"] == "abc"[p.argmax()] and r["score"] == pytest.approx(p.max(), abs=1e-4)
