"""SimHash near-duplicates: fingerprints, links within a bit radius, and connected groups.

Fingerprints that may be near meet by shared bits: 64 bits fall into six blocks, four differing
bits touch four of them at most, so any near pair agrees on two whole blocks. For each of the 15
pairs of blocks, fingerprints are grouped by those bits and compared within the group bit-sliced:
bit planes lie vertically, one machine word holds the same bit of 64 fingerprints, and distances
of all neighbours at one offset are summed by carry-save counters, plane by plane. Words whose 64
distances all exceed the radius are abandoned. A group over ``GROUP_LIMIT`` is not compared but
dealt out again by two more blocks of its remaining bits, which loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import framed, many_to_one, sliced, small_side, stored, unframed
from martloom.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
# One more block than differing bits ensures an equal block, two more ensure two.
EQUAL_BLOCKS = 2
# Largest group compared at once, and fingerprints compared in one go.
GROUP_LIMIT = 8192
CHUNK = 65536
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint; 0 for a text without words.

    A bit is set if more than half of the shingles' hashes have it. A text of fewer words than a
    shingle is one shingle.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, bits (the fingerprint as a signed long) and text_hash of every row.

    A null text has no words. Null ids and repeated rows stay; other columns are ignored.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = [fingerprint(t or "", shingle) for t in batch.column(1).to_pylist()]
            bits = pa.array(np.array(prints, np.uint64).view(np.int64))
            names = ["doc_id", "bits", "text_hash"]
            yield pa.RecordBatch.from_arrays([batch.column(0), bits, batch.column(2)], names)

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"], F.xxhash64(docs["text"]))
    return rows.mapInArrow(of, "doc_id long, bits long, text_hash long")


# --- bit-sliced comparison -------------------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words; bit k of word w in row b is bit b of fingerprint 64 * w + k."""
    filled = np.zeros(-(-len(prints) // 64) * 64, "<u8")
    filled[: len(prints)] = prints
    bits = np.unpackbits(filled.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


class CarrySave:
    """Counts of set bits per lane, up to the first power of two above the radius."""

    def __init__(self, words: int, radius: int):
        self.radius = radius
        self.digits = [np.zeros(words, np.uint64) for _ in range(radius.bit_length())]
        self.over = np.zeros(words, np.uint64)

    def add(self, carry: np.ndarray) -> None:
        for k, digit in enumerate(self.digits):
            self.digits[k], carry = digit ^ carry, digit & carry
        self.over |= carry

    def exceeding(self) -> np.ndarray:
        """Lanes that count more than the radius."""
        above, equal = self.over.copy(), np.full(len(self.over), _ALL)
        for k in reversed(range(len(self.digits))):
            if self.radius >> k & 1:
                equal &= self.digits[k]
            else:
                above |= equal & self.digits[k]
                equal &= ~self.digits[k]
        return above

    def keep(self, at: np.ndarray) -> None:
        self.digits = [d[at] for d in self.digits]
        self.over = self.over[at]


def near_at(planes: np.ndarray, offset: int, asked: np.ndarray, radius: int) -> np.ndarray:
    """Lanes i, out of the ``asked`` bits, whose fingerprint is near fingerprint i + offset."""
    skip, shift = divmod(offset, 64)
    words = np.flatnonzero(asked)
    asked, last = asked[words], planes.shape[1] - 1
    counts = CarrySave(len(words), radius)
    for b in range(64):
        plane = planes[b]
        ahead = plane[np.minimum(words + skip, last)] >> np.uint64(shift)
        if shift:
            ahead |= plane[np.minimum(words + skip + 1, last)] << np.uint64(64 - shift)
        counts.add(plane[words] ^ ahead)
        if b % 8 == 7:
            left = asked & ~counts.exceeding()
            alive = np.flatnonzero(left)
            if not len(alive):
                return alive
            if b < 63 and 2 * len(alive) < len(words):
                words, asked = words[alive], asked[alive]
                counts.keep(alive)
    lanes = np.unpackbits(left.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(lanes)
    return words[word] * 64 + bit


def linked(prints: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Root position of each fingerprint: near ones of the same group are joined, also in chains.

    ``groups`` numbers the groups; rows of a group are adjacent, and larger groups come first.
    """
    n = len(prints)
    planes, root = bit_planes(prints), np.arange(n)
    sizes = np.bincount(groups)
    room = planes.shape[1] * 64
    for offset in range(1, int(sizes.max(initial=1))):
        reach = int(sizes[sizes > offset].sum())
        same = np.zeros(room, np.uint8)
        same[: reach - offset] = groups[: reach - offset] == groups[offset:reach]
        asked = np.packbits(same, bitorder="little").view("<u8")
        left = near_at(planes, offset, asked, radius)
        right = left + offset
        while len(left):
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def compare_groups(radius: int, limit: int):
    """Arrow batches of (used, shared, bits), sorted, to links (a, b, used).

    ``used`` 0 marks a link of two fingerprints; else the row is a fingerprint ``a`` of a group
    that is too large and was dealt by the bits ``used``.
    """

    def batch_of(a, b, used):
        arrays = [pa.array(np.asarray(c, np.int64)) for c in (a, b, used)]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "used"])

    def compare(used, shared, bits):
        new = np.concatenate(([True], (used[1:] != used[:-1]) | (shared[1:] != shared[:-1])))
        group = np.cumsum(new) - 1
        size = np.bincount(group)[group]
        order = np.lexsort((group, -size))
        order = order[size[order] > 1]
        if not len(order):
            return
        bits, group = bits[order], group[order]
        group = np.cumsum(np.concatenate(([True], group[1:] != group[:-1]))) - 1
        root = linked(bits.view(np.uint64), group, radius)
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield batch_of(bits[moved], bits[root[moved]], np.zeros(len(moved)))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
        large: tuple[int, int] | None = None
        for batch in batches:
            rows = np.concatenate(
                [*held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1
            )
            if large is not None:
                # The rest of a group that is already known to be too large.
                out = (rows[0] == large[0]) & (rows[1] == large[1])
                yield batch_of(rows[2, out], rows[2, out], rows[0, out])
                rows = rows[:, ~out]
                large = large if not rows.shape[1] else None
            held = [rows]
            if not rows.shape[1]:
                continue
            tail = int(
                np.flatnonzero((rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1]))[0]
            )
            if rows.shape[1] - tail > limit:
                large = (int(rows[0, -1]), int(rows[1, -1]))
                out = rows[:, tail:]
                yield batch_of(out[2], out[2], out[0])
                held = [rows[:, :tail]]
                tail, rows = tail, rows[:, :tail]
            if tail >= CHUNK:
                yield from within(rows[:, :tail])
                held = [rows[:, tail:]]
        rows = np.concatenate(held, axis=1)
        if rows.shape[1]:
            yield from within(rows)

    def within(rows):
        """Complete groups: large ones are passed on, the rest compared."""
        used, shared, bits = rows
        new = np.concatenate(([True], (used[1:] != used[:-1]) | (shared[1:] != shared[:-1])))
        group = np.cumsum(new) - 1
        wide = (np.bincount(group) > limit)[group]
        if wide.any():
            yield batch_of(bits[wide], bits[wide], used[wide])
        if not wide.all():
            yield from compare(used[~wide], shared[~wide], bits[~wide])

    return links


def block_masks(used: int, radius: int) -> list[int]:
    """Masks of bits on which any near pair, equal in the bits ``used``, agrees for one of them."""
    free = [b for b in range(64) if not used >> b & 1]
    blocks = radius + EQUAL_BLOCKS
    if len(free) < blocks:
        raise ValueError(f"a group cannot be dealt again by {blocks} blocks; raise its limit")
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(free, blocks)]
    return [used | a | b for a, b in combinations(parts, EQUAL_BLOCKS)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, radius: int = RADIUS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (a, b) between the distinct ``bits``, enough to connect all that lie within the radius."""
    found = []
    masks = [F.lit(_signed(m)) for m in block_masks(0, radius)]
    rows = prints.select(F.explode(F.array(*masks)).alias("used"), "bits")
    while True:
        shared = rows.select("used", F.col("used").bitwiseAND(F.col("bits")).alias("shared"), "bits")
        dealt = shared.repartition("used", "shared").sortWithinPartitions("used", "shared", "bits")
        out = stored(dealt.mapInArrow(compare_groups(radius, limit), "a long, b long, used long"))
        found.append(out.where("used = 0").select("a", "b"))
        wide = out.where("used != 0")
        spent = [r["used"] for r in wide.select("used").distinct().collect()]
        if not spent:
            break
        finer = F.create_map(
            *[
                c
                for used in spent
                for c in (
                    F.lit(used),
                    F.array(*[F.lit(_signed(m)) for m in block_masks(used % (1 << 64), radius)]),
                )
            ]
        )
        rows = wide.select(F.explode(finer[F.col("used")]).alias("used"), F.col("a").alias("bits"))
        rows = rows.distinct()
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


# --- groups ----------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, limit: int = GROUP_LIMIT
) -> DataFrame:
    """doc_id, text_hash, bits and component_id of every row of the documents.

    component_id is the smallest doc_id of all rows reachable over links of at most ``radius``
    differing bits (null if all of these ids are null). Copies share a fingerprint and are linked
    once. Texts without words share fingerprint 0 and link like any other; an empty table gives
    an empty one.
    """
    rows = stored(fingerprints(docs, shingle))
    prints = stored(
        rows.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    )
    rooted = components(links(prints.select("bits"), radius, limit))
    root = F.coalesce("root", "bits").alias("root")
    member = prints.join(rooted, prints["bits"] == rooted["node"], "left").select(
        "bits", "first_id", "n", root
    )
    member = stored(member)
    total = F.min("first_id").alias("component_id"), F.count("*").alias("members")
    group = member.groupBy("root").agg(*total)
    ids = many_to_one(member, group, ["root"], prints.count(), "members")
    ids = stored(ids.select("bits", "component_id", "n"))
    met = many_to_one(rows, ids, ["bits"], rows.count())
    return met.select("doc_id", "text_hash", "bits", "component_id")


def one_per_group(docs: DataFrame, **how: int) -> DataFrame:
    """The documents without all but one of each group: the smallest doc_id, then text hash, stays.

    Null ids come after all others. Of repeated rows of the document that stays, one stays.
    """
    found = stored(near_duplicates(docs, **how))
    key = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    # Rows whose group has no id at all are told apart by their fingerprint's group only; they
    # are few or an error of the source, and are grouped by their bits.
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("bits "), "bits"))
    best = found.groupBy(group.alias("g")).agg(F.min(key).alias("best"))
    ranked = found.select("doc_id", "text_hash", group.alias("g")).join(best, "g")
    same = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & F.col("best.text_hash").eqNullSafe(
        F.col("text_hash")
    )
    # Each (doc_id, text) once: how often it occurs, and whether it is its group's choice.
    fate = stored(
        ranked.groupBy("doc_id", "text_hash").agg(F.max(same).alias("stays"), F.count("*").alias("n"))
    )
    hashed = framed(docs).withColumn("_hash", F.xxhash64("in_text"))

    def met(side: DataFrame, kind: str) -> DataFrame:
        side = small_side(side.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of")))
        same_id = F.col("in_doc_id").cast("long").eqNullSafe(F.col("_id"))
        return hashed.join(side, same_id & (F.col("_hash") == F.col("_of")), kind)

    repeated = fate.where("stays and n > 1")
    kept = unframed(met(fate.where("not stays or n > 1"), "left_anti"), docs)
    if repeated.isEmpty():
        return kept
    again = met(repeated, "left_semi").dropDuplicates(["in_doc_id", "_hash"])
    return kept.unionByName(unframed(again, docs))
