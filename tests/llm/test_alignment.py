"""Alignment against a plain version that looks at every pair of tokens."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martloom.llm import alignment
from martloom.llm.common import read
from martloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BYTES, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [" ", "\n", "  a b", "a  b", "a\n\nb", "a \nb", "tab\tx", "x\x1cy z", "it's I'LL 'sx", "12 345 ½ x²",
       "<|endoftext|> hi", "<s>a</s> <unk>", "a b ", "日本語 テキスト", "ΣΑΣ 🙂🙂", "x \x00y", "\x85 a\x85b",
       "é é ÇA", "a▁b c", "a\nb c\nd", "x;\ry", "<0x41> q", "ﬁ x", "a\n b", "word " * 3000 + "end"]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
        self.a.encode_special_tokens = True
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {chr(b): b for b in visible}
        self.letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def tokens(self, text):
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        spelled_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in ids_a]
        spelled_b = []
        for i in ids_b:
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            spelled_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        return ids_a, spelled_a, ids_b, spelled_b

    def align(self, text):
        """n_a, n_b, groups and links (a, b) of a text."""
        ids_a, spelled_a, ids_b, spelled_b = self.tokens(text or "")
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            return 0, 0, [], []
        ranges = []
        for spelled in (spelled_a, spelled_b):
            ends = [sum(map(len, spelled[: i + 1])) for i in range(len(spelled))] if len(spelled) < 500 else None
            if ends is None:
                ends, at = [], 0
                for s in spelled:
                    at += len(s)
                    ends.append(at)
            ranges.append([(e - len(s), e) for e, s in zip(ends, spelled)])
        links, groups, first = [], [], 0
        for i, (start, end) in enumerate(ranges[0]):
            while first < len(ids_b) and ranges[1][first][1] <= start:
                first += 1
            j = first
            while j < len(ids_b) and ranges[1][j][0] < end:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        sides = [[], []]
        for side, ids in ((0, ids_a), (1, ids_b)):
            at = 0
            for cut in cuts:
                held = []
                while at < len(ids) and ranges[side][at][1] <= cut:
                    held.append(str(ids[at]))
                    at += 1
                sides[side].append(",".join(held))
        groups = [f"{x}|{y}" for x, y in zip(*sides)]
        return len(ids_a), len(ids_b), groups, links


def plain_rows(texts):
    plain, found = Plain(), {}
    for text in set(texts):
        found[text] = plain.align(text)
    counts = Counter(link for text in texts for link in found[text][3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for text in texts:
        n_a, n_b, groups, links = found[text]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        rows.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return rows


def measures(frame):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(map(repr, (tuple(r) for r in frame.select(*columns).collect())))


def test_query_equals_plain_version(spark):
    docs = read(spark, SF, "documents").collect()
    want = plain_rows([r["text"] for r in docs])
    expected = sorted(repr((r["doc_id"], *w)) for r, w in zip(docs, want))
    assert measures(QUERIES["op12_token_alignment"](spark, SF)) == expected


def test_odd_texts_nulls_and_copies(spark):
    texts = [*ODD, *ODD[8:14], None, None, "", *["the same copy of a text"] * 40]
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `key` string, pair int")
    expected = sorted(repr((r[0], *w)) for r, w in zip(rows, plain_rows(texts)))
    assert measures(alignment.alignments(docs, BYTES, PIECES)) == expected
    assert alignment.alignments(docs.where("false"), BYTES, PIECES).count() == 0


@pytest.mark.parametrize("most", [1, 90_000_000])
def test_words_are_kept_within_their_bytes(monkeypatch, most):
    monkeypatch.setattr(alignment, "CACHE_BYTES", most)
    align, plain = alignment.Aligner(BYTES, PIECES), Plain()
    for text in ["one two\nthree two", "two ▁ one", "three one\ntwo", *ODD[:12]] * 2:
        groups, links, counts = align.all([text])[0]
        n_a, n_b, want, pairs = plain.align(text)
        assert (groups, len(links)) == (";".join(want), 8 * len(pairs)) and bool(counts) == bool(want)
