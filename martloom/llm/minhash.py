"""MinHash near-duplicates by one-permutation hashing.

A document is the set of its shingles' 64-bit hashes. One hash per shingle is enough: the hashes
fall into ``BINS`` bins by their top bits and each bin keeps its smallest. An empty bin borrows the
value of the first filled bin in an order of its own, the same for all documents (optimal
densification: every filled bin is as likely, so two sets agree in a bin as often as they overlap).
``BANDS`` runs of ``BINS // BANDS`` bins are hashed to buckets; sets that share half of their bins'
runs by chance are rare, and a pair at the threshold of 0.85 misses all 64 buckets once in 10^9.

Within a bucket the candidates form a star: its smallest member with each other one. A set meets the
centre it shares most buckets with first, the others if it is still apart from them. All links are
confirmed on the full sets. A bucket whose members the links have not joined is looked at
again with other centres, more in each round, until every pair of members is either in one group or
was compared; so stars lose no link. In these rounds a pair is compared by a sketch first, one bit of
each of 256 bins: overlapping sets differ in few of them, and a pair at the threshold is taken for
farther apart once in 10^9; pairs of several buckets are compared in one of them. Crowded buckets are
cut into blocks of centres and members, whose full sets meet inside a task: only links leave it, one
for each two groups. Equal sets are one node throughout, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import many_to_one, sliced, small_side, stored
from martloom.llm.components import components
from martloom.llm.words import WordHashes, mixed, runs

SHINGLE = 5
PERCENT = 85
BINS, BANDS = 512, 64
# Centres of a bucket in the first round after the star, and how many times more in each further one.
CENTRES, MORE = 16, 4
# Centres, each with the keys of its buckets, that are broadcast at most.
CENTRE_ROWS = 20_000
# Comparisons of a bucket in one round beyond which they are made inside tasks, and the members of such
# a bucket that a task holds of either side.
CROWDED, BLOCK = 256, 256
# Longs of a sketch, and the standard deviations (7.8) that a pair at the threshold may differ beyond
# the expected number of bits.
SKETCH, BEYOND = 4, 7.8
# Sets with fewer filled bins find all lenders at once; those with more try one after the other.
_FEW = 32
# Nodes whose buckets a task has passed on and does not repeat.
_SEEN = 200_000


def shingle_set(text: str | None, words: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the shingles; fewer words than a shingle are one; none, none."""
    found = (text or "").encode().lower().split()
    return np.unique(runs(words.of(found), min(shingle, len(found)))) if found else np.zeros(0, np.uint64)


@cache
def _lenders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin the other bins in its own order, and the place of each bin in that order."""
    seeds = np.arange(bins * bins, dtype=np.uint64) + np.uint64(1 << 32)
    order = np.argsort(mixed(seeds).reshape(bins, bins), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(bins)[None, :], axis=1)
    return order.astype(np.int32), place.astype(np.int32)


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Smallest hash of each bin of a sorted, filled set; empty bins borrow."""
    at = (hashes >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    filled, values = at[first], np.zeros(bins, np.uint64)
    values[filled] = hashes[first]
    if len(filled) == bins:
        return values
    order, place = _lenders(bins)
    has = np.zeros(bins, bool)
    has[filled] = True
    empty = np.flatnonzero(~has)
    if len(filled) < _FEW:
        values[empty] = values[filled[place[empty[:, None], filled].argmin(axis=1)]]
        return values
    step = 0
    while len(empty):
        lender = order[empty, step]
        lends = has[lender]
        values[empty[lends]] = values[lender[lends]]
        empty, step = empty[~lends], step + 1
    return values


def sketch(values: np.ndarray) -> np.ndarray:
    """One bit of each of the first bins of a signature."""
    some = values[: 64 * SKETCH]
    bits = mixed(some + np.arange(len(some), dtype=np.uint64)) >> np.uint64(63)
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def sketch_limit(percent: int) -> int:
    """Bits in which the sketches of sets that overlap by ``percent`` may differ."""
    n, p = 64 * SKETCH, (1 - percent / 100) / 2
    return int(n * p + BEYOND * (n * p * (1 - p)) ** 0.5)


def bucket_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key for each band of a signature."""
    rows = values.reshape(bands, -1)
    total = np.arange(bands, dtype=np.uint64)
    for k in range(rows.shape[1]):
        total = mixed(total ^ rows[:, k])
    return total


def set_hash(hashes: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    total = mixed(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def can_link(n: Column | int, percent: int) -> Column | bool:
    """Whether a set of n may link with a different one at all."""
    return 100 * n >= percent * (n + 1)


def shingled(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, node (name of the set; null without words), n, keys and bits of every row.

    keys and bits (the sketch) are null for sets that cannot link, and for sets that the same task has
    passed on before.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(), set()
        for batch in sliced(batches):
            nodes, sizes, keys, bits = [], [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_set(text, words, shingle)
                node = set_hash(hashes) if len(hashes) else None
                nodes.append(node)
                sizes.append(len(hashes))
                fresh = node is not None and node not in seen and can_link(len(hashes), percent)
                values = signature(hashes) if fresh else None
                keys.append(bucket_keys(values).view(np.int64) if fresh else None)
                bits.append(sketch(values) if fresh else None)
                if fresh:
                    seen = seen if len(seen) < _SEEN else set()
                    seen.add(node)
            columns = [
                batch.column(0), batch.column(2), pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in (keys, bits)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n", "keys", "bits"])

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"], F.xxhash64(docs["text"]))
    schema = "doc_id long, text_hash long, node long, n long, keys array<long>, bits array<long>"
    return rows.mapInArrow(of, schema)


# --- candidates ------------------------------------------------------------------------

_MEMBERS = "key long, node long, n long, centre long, centre_n long, edge boolean"


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, node, n) to the members of shared buckets with the smallest one, its centre.

    A bucket may go on in the tasks before and after; the centres of a task's first and last bucket
    are therefore passed on once more (``edge``).
    """
    held = np.zeros((3, 0), np.int64)  # the centre of the bucket that the last batch ended in
    given, last_node, opened, first_key = False, None, False, None

    def out(rows, centre, edge):
        arrays = [pa.array(c) for c in (*rows, centre[1], centre[2])]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(np.full(rows.shape[1], edge))],
            ["key", "node", "n", "centre", "centre_n", "edge"],
        )

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if not rows.shape[1]:
            continue
        same = (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])
        again = held.shape[1] > 0 and rows[0, 0] == held[0, 0] and rows[1, 0] == last_node
        rows = rows[:, ~np.concatenate(([again], same))]
        if not rows.shape[1]:
            continue
        last_node = rows[1, -1]
        n_held = held.shape[1]
        rows = np.concatenate([held, rows], axis=1)
        new = np.concatenate(([True], rows[0, 1:] != rows[0, :-1]))
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        sizes = np.bincount(run)
        centre = rows[:, starts[run]]
        if not opened:
            opened, first_key = True, rows[0, 0]
            yield out(rows[:, :1], rows[:, :1], True)
        emit = sizes[run] > 1
        if n_held and given:
            emit[0] = False
        yield out(rows[:, emit], centre[:, emit], False)
        given = bool(sizes[-1] > 1) or (len(sizes) == 1 and n_held > 0 and given)
        held = rows[:, starts[-1] : starts[-1] + 1]
    if held.shape[1] and held[0, 0] != first_key:
        yield out(held, held, True)


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """(key, node, n, centre, centre_n) for the different nodes of every bucket with more than one.

    Buckets are dealt by ranges of key and node, so that one with many members lies in many tasks,
    each with a centre of its own; those are hung on the smallest of them.
    """
    rows = keyed.select(F.explode("keys").alias("key"), "node", "n")
    dealt = rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    found = stored(dealt.mapInArrow(stars, _MEMBERS))
    edges = found.where("edge").select("key", "node", "n").distinct()
    first = edges.groupBy("key").agg(
        F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("tasks")
    )
    between = edges.join(first.where("tasks > 1"), "key").select(
        "key", "node", "n", F.col("first.node").alias("centre"), F.col("first.n").alias("centre_n")
    )
    return found.where("not edge").drop("edge").unionByName(between)


def alike(n: str, m: str, percent: int) -> Column:
    """Sizes that allow a link at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def ordered_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    low, high = F.least(a, b).alias("a"), F.greatest(a, b).alias("b")
    return pairs.where(F.col(a) != F.col(b)).select(low, high).distinct()


# --- confirmation ----------------------------------------------------------------------


def full_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node, hashes (little-endian) for the nodes wanted, from one row of each."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    chosen = rows.join(small_side(nodes), "node", "left_semi").groupBy("node").agg(first.alias("f"))
    chosen = stored(chosen.select("node", F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_of")))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(), set()
        for batch in sliced(batches):
            nodes, sets = [], []
            for node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node not in seen:
                    seen = seen if len(seen) < _SEEN else set()
                    seen.add(node)
                    nodes.append(node)
                    sets.append(shingle_set(text, words, shingle).astype("<u8").tobytes())
            columns = [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "hashes"])

    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"], F.xxhash64(docs["text"]).alias("_hash")
    )
    same = (F.col("_hash") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    met = texts.join(small_side(chosen), same).select("node", "text")
    # Rows of one id and text that came to several tasks.
    return met.mapInArrow(of, "node long, hashes binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets overlap enough."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x = np.frombuffer(x.as_buffer(), "<u8")
                y = np.frombuffer(y.as_buffer(), "<u8")
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    met = pairs.join(right, "b").select("a", "b", "hashes_b")
    # A star's centre is in many pairs: its set goes to their tasks, they do not come to its.
    both = many_to_one(met, left.join(counts, "a"), ["a"], pairs.count())
    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(of, "a long, b long")


def block_links(rows: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the centres and the members of blocks, one for each two groups of a block.

    ``rows`` has key, i, j (the block), node, root and centre_keys, which is null for members and tells
    the buckets of a centre otherwise; ``facts`` has node, keys (one for each band) and hashes. A pair is
    compared in the smallest of the centre's buckets that both share.
    """
    none = np.iinfo(np.int64).max

    def of(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        key, node, root = block["key"][0].as_py(), block["node"].to_numpy(), block["root"].to_numpy()
        keys = block["keys"].combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1)
        sets = [np.frombuffer(h.as_buffer(), "<u8") for h in block["hashes"]]
        sizes = np.array([len(s) for s in sets])
        centres = np.flatnonzero(block["centre_keys"].is_valid().to_numpy())
        members = np.flatnonzero(block["centre_keys"].is_null().to_numpy())
        links = []
        for c in centres:
            own = np.isin(keys[c], block["centre_keys"][int(c)].values.to_numpy())
            here = np.where((keys[members] == keys[c]) & own, keys[members], none).min(axis=1) == key
            less, more = np.minimum(sizes[members], sizes[c]), np.maximum(sizes[members], sizes[c])
            met = members[here & (root[members] != root[c]) & (100 * less >= percent * more)]
            if not len(met):
                continue
            hashes = np.concatenate([sets[m] for m in met])
            at = np.searchsorted(sets[c], hashes)
            at[at == sizes[c]] = 0
            starts = np.concatenate(([0], np.cumsum(sizes[met])[:-1]))
            common = np.add.reduceat((sets[c][at] == hashes).astype(np.int64), starts)
            near = met[100 * common >= percent * (sizes[met] + sizes[c] - common)]
            links += [(root[c], root[m], node[c], node[m]) for m in near]
        # One link joins two groups as well as many.
        first = {(min(x, y), max(x, y)): (a, b) for x, y, a, b in links}
        ends = np.array(list(first.values()), np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    whole = rows.join(facts, "node").select("key", "i", "j", "node", "root", "centre_keys", "keys", "hashes")
    return whole.groupBy("key", "i", "j").applyInArrow(of, "a long, b long")


def blocks(left: DataFrame, centre: DataFrame, crowded: DataFrame) -> DataFrame:
    """The members and centres of crowded buckets, each in all blocks in which it meets the other side."""
    wide = [F.ceil(F.col(c) / BLOCK) for c in ("n_centres", "total")]

    def place(side: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(side)), wide[side])

    def every(side: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), wide[side] - 1))

    no_keys = F.lit(None).cast("array<long>").alias("centre_keys")
    crowded = small_side(crowded)
    members = left.join(crowded, "key").select(
        "key", every(0).alias("i"), place(1).alias("j"), "node", "root", no_keys
    )
    centres = centre.join(crowded, "key").select(
        "key", place(0).alias("i"), every(1).alias("j"), "node", "root", "centre_keys"
    )
    return members.unionByName(centres)


def joined_groups(grouped: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of the groups after new links (a, b); groups count as links of nodes to their root."""
    links = stored(links)
    if grouped is not None:
        if links.isEmpty():
            return grouped
        links = links.unionByName(grouped.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return stored(components(links))


def apart_pairs(pairs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one group yet."""
    for end in ("a", "b"):
        root = grouped.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(small_side(root), end, "left")
    same = F.coalesce("root_a", "a") == F.coalesce("root_b", "b")
    return pairs.where(~same).select("a", "b")


def linked(docs: DataFrame, rows: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, root) of the nodes that link with others; ``rows`` is ``shingled``."""
    members = stored(shared_buckets(rows.where("keys is not null")))
    sets = stored(full_sets(docs, rows, members.select("node").distinct(), shingle))
    star = members.where(alike("n", "centre_n", percent) & (F.col("node") != F.col("centre")))
    star = stored(star.groupBy(F.col("centre").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared")))
    # Each node first meets the centre it shares most buckets with; other centres only if that has not
    # brought them into one group.
    nearest = F.min(F.struct((-F.col("shared")).alias("less"), "a"))
    first = stored(star.groupBy("b").agg(nearest.alias("f")).select("f.a", "b"))
    grouped = joined_groups(None, confirmed(first, sets, percent))
    rest = stored(apart_pairs(star.join(first, ["a", "b"], "left_anti").select("a", "b"), grouped))
    grouped = joined_groups(grouped, confirmed(rest, sets, percent))
    members, centres = members.select("key", "node", "n").distinct(), CENTRES
    bits = [F.col("bits")[k].alias(f"bits{k}") for k in range(SKETCH)]
    sketches = rows.where("keys is not null").select("node", "keys", *bits).dropDuplicates(["node"])
    sketches = stored(sketches.join(sets.select("node"), "node", "left_semi"))
    facts = sketches.select("node", "keys").join(sets, "node")
    while True:
        named = members.join(grouped, "node", "left").select(
            "key", "node", "n", F.coalesce("root", "node").alias("root")
        )
        sizes = stored(named.groupBy("key", "root").agg(F.count("*").alias("held")))
        largest = F.max(F.struct("held", "root"))
        open_keys = sizes.groupBy("key").agg(
            largest.alias("most"), F.sum("held").alias("total"), F.count("*").alias("groups")
        )
        open_keys = stored(
            open_keys.where("groups > 1").select(
                "key", F.col("most.root").alias("main"), "total",
                (F.col("total") - F.col("most.held")).alias("others"),
            )
        )
        if open_keys.isEmpty():
            return grouped
        # Members outside of the largest group, all or some of them, are compared with all others of
        # their bucket and leave it.
        left = stored(named.join(small_side(open_keys.drop("total")), "key"))
        share = F.ceil(F.col("others") / centres)
        chosen = F.pmod(F.xxhash64("node", F.lit(centres)), share) == 0
        spent = stored(left.where((F.col("root") != F.col("main")) & chosen))
        # The buckets in which a node is a centre now, 64 at most.
        own = spent.groupBy("node").agg(F.collect_set("key").alias("centre_keys"))
        centre = stored(spent.join(own, "node").select("key", "node", "n", "root", "centre_keys"))
        held = centre.groupBy("key").agg(F.count("*").alias("n_centres"))
        crowded = stored(
            open_keys.join(held, "key").where(F.col("n_centres") * F.col("total") > CROWDED)
            .select("key", "n_centres", "total")
        )
        named_keys = small_side(crowded.select("key"))
        apart = reduce(
            lambda x, y: x + y,
            [F.bit_count(F.col(f"bits{k}").bitwiseXOR(F.col(f"centre_bits{k}"))) for k in range(SKETCH)],
        )
        # A pair that meets in several buckets now is compared in one of them only. If the node has left
        # that one, it was compared there before.
        here = F.array_min(F.array_intersect("keys", "centre_keys")) == F.col("key")
        few = centre.join(named_keys, "key", "left_anti").join(sketches, "node").select(
            "key", F.col("node").alias("centre"), F.col("n").alias("centre_n"), F.col("root").alias("of"),
            "centre_keys", *[F.col(f"bits{k}").alias(f"centre_bits{k}") for k in range(SKETCH)],
        )
        loose = left.join(named_keys, "key", "left_anti").join(sketches, "node")
        met = loose.join(small_side(stored(few), CENTRE_ROWS), "key").where(
            (F.col("root") != F.col("of")) & alike("n", "centre_n", percent)
            & (apart <= sketch_limit(percent)) & here
        )
        pairs = stored(ordered_pairs(met, "node", "centre"))
        links = confirmed(pairs, sets, percent)
        if not crowded.isEmpty():
            links = links.unionByName(block_links(blocks(left, centre, crowded), facts, percent))
        grouped = joined_groups(grouped, links)
        gone = spent.select("key", "node")
        members = stored(left.join(gone, ["key", "node"], "left_anti").select("key", "node", "n"))
        centres *= MORE


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of the documents.

    component_id is the smallest doc_id of all rows reachable over sets that overlap by ``percent``
    (null if all of these ids are null); kept says whether it is the row's own. A row without words
    is linked with nothing, not even its like, and is kept. Rows without an id are kept only if they
    have no words or their group has no id. Repeated rows stay; an empty table gives an empty one.
    Links are found, and stored, while the query is built.
    """
    rows = stored(shingled(docs, shingle, percent))
    nodes = stored(
        rows.where("node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    )
    rooted = linked(docs, rows, shingle, percent)
    member = stored(
        nodes.join(rooted, "node", "left").select(
            "node", "first_id", "n", F.coalesce("root", "node").alias("root")
        )
    )
    group = member.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.count("*").alias("members")
    )
    ids = many_to_one(member, group, ["root"], nodes.count(), "members")
    ids = stored(ids.select("node", "component_id", F.col("n").alias("rows")))
    wordy = rows.where("node is not null").select("doc_id", "node", F.col("n").alias("n_shingles"))
    met = many_to_one(wordy, ids, ["node"], rows.count(), "rows")
    bare = rows.where("node is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    whole = met.select("doc_id", "n_shingles", "component_id").unionByName(bare)
    return whole.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
