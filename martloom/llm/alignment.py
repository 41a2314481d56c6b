"""Alignment of the tokens of two tokenizers, over the corpus, each different text once.

Rows are shuffled by their full text and counted. Each different text is then tokenised by both
files, and its tokens are aligned by their bytes: two tokens are linked where their ranges overlap,
and places where both end a token cut the text into groups. A text's different links are stored
with their numbers; the corpus-wide count of a link weighs them by the copies of the text. Measures of
a text are joined back to the rows that have it.

A is a byte-level ``tokenizers`` file, read with a space before the text; B a ``sentencepiece`` file
that adds one itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import many_to_one, sliced, small_side, stored
from martloom.llm.tokens import byte_letters, encoder, has_odd_space

# Links that are sent to all executors, 16 bytes each; beyond, Spark shuffles.
BROADCAST_LINKS = 2_000_000
# Bytes of the young half of the words' cache, and of an entry besides its key and value.
CACHE_BYTES, ENTRY_BYTES = 90_000_000, 400
_SPACE = "▁"


class Side:
    """The tokens of a tokenizer by id: their lengths, all their bytes in a row, and the id as text
    with one of the marks behind it (mark 0 for the ids at first, then mark 1, ...)."""

    def __init__(self, tokens: list[bytes], marks: str):
        self.named = np.array([f"{i}{m}" for m in marks for i in range(len(tokens))], object)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))]


class ByteSide(Side):
    """A byte-level vocabulary; the text is read with a space before it."""

    def __init__(self, path: str):
        encode = encoder(path, plain=True)
        self.tokenizer = encode.tokenizer
        letters = {letter: byte for byte, letter in byte_letters().items()}
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            known = all(c in letters for c in name)
            tokens[k] = bytes(letters[c] for c in name) if known else name.encode()
        super().__init__(tokens, ",|")

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide(Side):
    """A ``sentencepiece`` vocabulary with bytes for unknown characters.

    ``by_word``: no piece holds a space mark behind other characters, or a line break, so words
    after a single space or a line break are read alike whatever stands around them.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = {i: bytes([int(p[1:-1], 16)]) for i, p in enumerate(pieces) if self.model.is_byte(i)}
        tokens = [byte.get(i) or p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        super().__init__(tokens, ",;\n")
        inner = any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)
        probe = self.model.encode("\n")
        self.by_word = not inner and len(probe) == 2 and [pieces[i] for i in probe] == [_SPACE, "<0x0A>"]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Alignment:
    """Links and groups of the tokens of some texts, one after the other."""

    def __init__(self, a: Side, b: Side, ids_a: list[list[int]], ids_b: list[list[int]], text: bytes):
        self.of_a = np.array([len(i) for i in ids_a], np.int64)
        self.of_b = np.array([len(i) for i in ids_b], np.int64)
        all_a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(self.of_a.sum()))
        all_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(self.of_b.sum()))
        ends_a, ends_b = np.cumsum(a.lengths[all_a]), np.cumsum(b.lengths[all_b])
        whole = np.frombuffer(text, np.uint8)
        self.spells = (
            len(ends_a) > 0 and len(ends_b) > 0
            and ends_a[-1] == ends_b[-1] == len(whole)
            and np.array_equal(a.spelled(all_a, ends_a), whole)
            and np.array_equal(b.spelled(all_b, ends_b), whole)
        )
        if not self.spells:
            return
        # Between two neighbouring ends of either side lies exactly one overlap.
        is_a, is_b = np.zeros(len(whole) + 1, bool), np.zeros(len(whole) + 1, bool)
        is_a[ends_a], is_b[ends_b] = True, True
        self.cuts, shared = np.flatnonzero(is_a | is_b), is_a & is_b
        at_a = (np.cumsum(is_a) - is_a)[self.cuts]
        at_b = (np.cumsum(is_b) - is_b)[self.cuts]
        self.links = all_a[at_a] << 32 | all_b[at_b]
        self.last_a, self.last_b = shared[ends_a], shared[ends_b]
        self.a, self.b, self.ids_a, self.ids_b, self.ends_b = a, b, all_a, all_b, ends_b
        self.group_ends = ends_a[self.last_a]

    def groups(self, ends: np.ndarray) -> list[str]:
        """The groups up to each of the given ends, as a1,a2|b1;a3|b2,b3."""
        a, b = self.a, self.b
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        # All of a group's a come before its b, and groups follow each other.
        b_before = np.concatenate(([0], np.cumsum(np.bincount(group_b))))
        a_before = np.cumsum(np.bincount(group_a))
        parts = np.empty(len(self.ids_a) + len(self.ids_b), object)
        parts[np.arange(len(self.ids_a)) + b_before[group_a]] = a.named[
            self.ids_a + self.last_a * len(a.lengths)
        ]
        mark = self.last_b.astype(np.int64)
        mark[np.searchsorted(self.ends_b, ends)] = 2
        parts[np.arange(len(self.ids_b)) + a_before[group_b]] = b.named[
            self.ids_b + mark * len(b.lengths)
        ]
        return "".join(parts.tolist()).split("\n")[:-1]


Entry = tuple[str, bytes, bytes]  # groups, links (int64), and n_a, n_b, n_groups, n_links (int32)
NOTHING: Entry = ("", b"", b"")


class Aligner:
    """Aligned texts from aligned words, which are kept as long as they fit."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        self.young: dict[bytes, Entry] = {}
        self.old: dict[bytes, Entry] = {}
        self.held = 0

    def whole(self, text: str) -> Entry:
        """A text at once, as the libraries read it."""
        spaced = " " + text
        found = Alignment(self.a, self.b, self.a.ids([spaced]), self.b.ids([text]), spaced.encode())
        if _SPACE in text or not found.spells:
            return NOTHING
        (groups,) = found.groups(found.ends_b[-1:])
        counts = [len(found.ids_a), len(found.ids_b), len(found.group_ends), len(found.links)]
        return groups, found.links.tobytes(), np.array(counts, np.int32).tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Aligns new words: each after a space, or after the line break that it starts with."""
        # In slices, so that their arrays stay small whatever the length of a word.
        for at in range(0, len(words), 4096):
            self._learn(words[at : at + 4096])

    def _learn(self, words: list[bytes]) -> None:
        broken = [w[:1] == b"\n" for w in words]
        texts = [w.decode() for w in words]
        ids_a = self.a.ids([t if n else " " + t for t, n in zip(texts, broken, strict=True)])
        ids_b = [i[1:] if n else i for i, n in zip(self.b.ids(texts), broken, strict=True)]
        spelled = b"".join(w if n else b" " + w for w, n in zip(words, broken, strict=True))
        found = Alignment(self.a, self.b, ids_a, ids_b, spelled)
        if not found.spells:
            # Some word cannot be spelled: each for itself, and its texts have no tokens.
            if len(words) > 1:
                for word in words:
                    self._learn([word])
            else:
                self._keep(words[0], NOTHING)
            return
        word_ends = np.cumsum([len(w) + (not n) for w, n in zip(words, broken, strict=True)])
        n_links = np.diff(np.searchsorted(found.cuts, word_ends, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(found.group_ends, word_ends, "right"), prepend=0)
        counts = np.stack([found.of_a, found.of_b, n_groups, n_links], axis=1).astype(np.int32)
        links, numbers = found.links.tobytes(), counts.tobytes()
        ends = (8 * np.cumsum(n_links)).tolist()
        groups = found.groups(word_ends)
        for i, (word, named, start, end) in enumerate(zip(words, groups, [0, *ends], ends)):
            self._keep(word, (named, links[start:end], numbers[16 * i : 16 * i + 16]))

    def _keep(self, word: bytes, entry: Entry) -> None:
        self.young[word] = entry
        self.held += len(word) + len(entry[0]) + len(entry[1]) + ENTRY_BYTES

    def _entries(self, words: list[bytes]) -> list[Entry]:
        found = list(map(self.young.get, words))
        if None in found:
            new = []
            for word in {w for w, f in zip(words, found, strict=True) if f is None}:
                if word in self.old:
                    self._keep(word, self.old[word])
                else:
                    new.append(word)
            self.learn(new)
            found = list(map(self.young.get, words))
        return found

    def all(self, texts: list[str]) -> list[Entry]:
        """An entry for every text; without tokens if either side does not spell it."""
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        split = [
            None if not self.b.by_word or _SPACE in t or has_odd_space(t, d)
            else d.replace(b"\n", b" \n").split(b" ")
            for t, d in ((t, t.encode()) for t in texts)
        ]
        # New words of all texts at once: a call of the libraries for each would cost more than they do.
        self._entries(list({w for words in split if words for w in words}))
        found = []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                found.append(self.whole(text))
                continue
            groups, links, counts = zip(*self._entries(words), strict=True)
            if b"" in counts:
                found.append(NOTHING)
                continue
            total = np.frombuffer(b"".join(counts), np.int32).reshape(-1, 4).sum(axis=0, dtype=np.int32)
            found.append((";".join(groups), b"".join(links), total.tobytes()))
        return found


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for each Python worker."""
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def text_alignments(texts: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """key, copies, measures, and pairs (a << 32 | b) with how often the text links them (times)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(byte_path, piece_path)
        lists = pa.list_(pa.int64()), pa.list_(pa.int32())
        names = ["key", "key2", "copies", *(f.split()[0] for f in _MEASURES.split(", ")), "pairs", "times"]
        for batch in sliced(batches, 64):
            entries = align.all(batch.column(3).to_pylist())
            none = np.zeros(4, np.int32).tobytes()
            counts = np.frombuffer(b"".join(c or none for _, _, c in entries), np.int32).reshape(-1, 4)
            digests, pairs, times = [], [], []
            for groups, links, _ in entries:
                digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                linked = np.sort(np.frombuffer(links, np.int64))
                first = np.flatnonzero(np.diff(linked, prepend=-1))
                pairs.append(linked[first])
                times.append(np.diff(first, append=len(linked)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    *(pa.array(c.astype(np.int64)) for c in counts.T),
                    pa.array(digests, pa.string()),
                    pa.array(pairs, lists[0]),
                    pa.array(times, lists[1]),
                ],
                names,
            )

    schema = f"key long, key2 long, copies long, {_MEASURES}, pairs array<long>, times array<int>"
    return texts.mapInArrow(of, schema)


def link_counts(alignments: DataFrame) -> DataFrame:
    """pair, count over the corpus, best: whether no other a is linked with that b more often."""
    rows = alignments.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = stored(
        rows.groupBy(F.col("p.pairs").alias("pair")).agg(
            F.sum(F.col("p.times") * F.col("copies")).alias("count")
        )
    )
    b = F.col("pair").bitwiseAND((1 << 32) - 1).alias("b")
    most = counts.groupBy(b).agg(F.max("count").alias("most"))
    named = counts.select("pair", "count", b).join(most, "b")
    return named.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    n_links is the number of overlapping token pairs, n_best of those whose count over the corpus is
    the highest of their b (ties included), count_sum the sum of those counts. Null and empty texts,
    and texts that either side cannot spell, have zeros and an empty digest; they are no part of
    the counts. Null ids and repeated rows stay, other columns are ignored; an empty table gives an
    empty one. Texts are aligned, and stored, while the query is built.
    """
    keys = [F.xxhash64("text").alias("key"), F.xxhash64(F.lit(1), F.col("text")).alias("key2")]
    texts = docs.where(F.length("text") > 0).select("text").groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select(*keys, "copies", "text")
    # Alignments take longer than the shuffle delivers: dealt by rows, not by bytes.
    found = stored(text_alignments(texts, byte_path, piece_path))
    counts = stored(link_counts(found))
    links = found.where("n_links > 0").select(
        "key", "key2", F.explode(F.arrays_zip("pairs", "times")).alias("p")
    )
    links = links.select("key", "key2", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    sums = (
        links.join(small_side(counts, BROADCAST_LINKS), "pair").groupBy("key", "key2")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    measures = found.drop("pairs", "times").join(sums, ["key", "key2"], "left")
    measures = stored(measures.na.fill(0, ["n_best", "count_sum"]))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    rows = stored(named.where(F.length("text") > 0).select("doc_id", *keys))
    met = many_to_one(rows, measures, ["key", "key2"], rows.count(), "copies")
    bare = named.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers], F.lit("").alias("groups_sha256")
    )
    return met.select("doc_id", *numbers, "groups_sha256").unionByName(bare)
