"""Language of a text by a bidirectional gated recurrent network over its bytes.

Both directions read windows of bytes; the unit has an update gate z and a candidate state c, and
moves by h = z * h + (1 - z) * c. Every byte gets a probability per language from both states, and a
document the mean over all of its bytes. The network is trained in numpy by backpropagation through
time on a bounded sample; prediction reads every text whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import sliced

UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    """Whether any character is of Unicode's category L (numerals and digits are not)."""
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Training:
    """At most ``docs`` documents are sampled, the same number of each language, with ``parts``
    excerpts of ``window`` characters spread over the whole text."""

    docs: int = 2400
    parts: int = 8
    window: int = 64
    units: int = 8
    steps: int = 400
    batch: int = 256
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Weights of both directions (0 forward, 1 backward) and of the output layer."""

    languages: list[str]
    inputs: np.ndarray  # (2, 256, 2 * units): gate, then candidate
    states: np.ndarray  # (2, units, 2 * units)
    outputs: np.ndarray  # (2, units, languages)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    @property
    def units(self) -> int:
        return self.states.shape[1]

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.outputs, self.bias]


def new_network(languages: list[str], units: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Network(
        languages,
        draw(2, 256, 2 * units, scale=0.3),
        draw(2, units, 2 * units, scale=units**-0.5),
        draw(2, units, len(languages), scale=units**-0.5),
        np.zeros(len(languages), np.float32),
    )


def read_states(net: Network, rows: np.ndarray, keep: bool = False):
    """States (2, bytes, rows, units) after each byte in reading order; ``rows`` is (bytes, rows).

    With ``keep``, gates and candidates are returned too, for training.
    """
    steps, n = rows.shape
    units = net.units
    # sigmoid(a) = tanh(a / 2) / 2 + 1 / 2, so that one call of tanh serves gate and candidate.
    half = np.concatenate([np.full(units, 0.5), np.ones(units)]).astype(np.float32)
    inputs, states = net.inputs * half, net.states * half
    h = np.zeros((2, n, units), np.float32)
    all_h = np.empty((2, steps, n, units), np.float32)
    acts = np.empty((2, steps, n, 2 * units), np.float32) if keep else None
    a = np.empty((2, n, 2 * units), np.float32)
    for t in range(steps):
        np.matmul(h, states, out=a)
        a[0] += inputs[0][rows[t]]
        a[1] += inputs[1][rows[steps - 1 - t]]
        np.tanh(a, out=a)
        z, c = a[:, :, :units], a[:, :, units:]
        z *= 0.5
        z += 0.5
        h = h - c
        h *= z
        h += c
        all_h[:, t] = h
        if keep:
            acts[:, t] = a
    return all_h, acts


def byte_probabilities(net: Network, all_h: np.ndarray) -> np.ndarray:
    """(bytes, rows, languages), in the order of the text."""
    scores = all_h[0] @ net.outputs[0]
    scores += (all_h[1] @ net.outputs[1])[::-1]
    scores += net.bias
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    return scores


def gradients(net: Network, rows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes and its gradients by backpropagation through time."""
    steps, n = rows.shape
    units = net.units
    all_h, acts = read_states(net, rows, keep=True)
    p = byte_probabilities(net, all_h)
    picked = p[:, np.arange(n), labels]
    loss = float(-np.log(picked + 1e-9).mean())
    d = p
    d[:, np.arange(n), labels] -= 1
    d /= steps * n
    faced = (d, d[::-1])
    d_inputs, d_states = np.zeros_like(net.inputs), np.zeros_like(net.states)
    d_outputs = np.stack([np.einsum("tnu,tnl->ul", all_h[k], faced[k]) for k in (0, 1)])
    from_out = np.stack([faced[k] @ net.outputs[k].T for k in (0, 1)])
    d_h = np.zeros((2, n, units), np.float32)
    d_a = np.empty((2, steps, n, 2 * units), np.float32)
    for t in reversed(range(steps)):
        before = all_h[:, t - 1] if t else np.zeros((2, n, units), np.float32)
        z, c = acts[:, t, :, :units], acts[:, t, :, units:]
        d_h += from_out[:, t]
        d_a[:, t, :, :units] = d_h * (before - c) * z * (1 - z)
        d_a[:, t, :, units:] = d_h * (1 - z) * (1 - c * c)
        d_h = d_h * z + d_a[:, t] @ net.states.transpose(0, 2, 1)
    for k in (0, 1):
        flat = d_a[k].reshape(-1, 2 * units)
        d_states[k] = all_h[k, :-1].reshape(-1, units).T @ d_a[k, 1:].reshape(-1, 2 * units)
        read = (rows if k == 0 else rows[::-1]).ravel()
        order = np.argsort(read, kind="stable")
        found, starts = np.unique(read[order], return_index=True)
        d_inputs[k][found] = np.add.reduceat(flat[order], starts, axis=0)
    return loss, [d_inputs, d_states, d_outputs, d.sum(axis=(0, 1))]


def byte_rows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (bytes, rows) of all texts, the bytes each row holds, and each text's first row."""
    n_rows = np.array([max(1, -(-len(t) // window)) for t in texts])
    joined = b"".join(
        t.ljust(int(k) * window, b"\0") for t, k in zip(texts, n_rows, strict=True)
    )
    rows = np.frombuffer(joined, np.uint8).reshape(-1, window).T
    first = np.cumsum(n_rows) - n_rows
    held = np.full(int(n_rows.sum()), window)
    held[first + n_rows - 1] = [len(t) - (int(k) - 1) * window for t, k in zip(texts, n_rows, strict=True)]
    return np.ascontiguousarray(rows), held, first


def train(texts: list[str], languages: list[str], how: Training = Training()) -> Network:
    """A network for the languages given, from excerpts and their languages, by Adam."""
    names = sorted(set(languages))
    net = new_network(names, how.units, how.seed)
    if len(names) < 2:
        return net
    rows, held, first = byte_rows([t.encode() for t in texts], how.window)
    counts = np.diff(np.append(first, rows.shape[1]))
    labels = np.repeat([names.index(x) for x in languages], counts)
    # Rows that are mostly filling teach nothing.
    full = np.flatnonzero(held * 2 >= how.window)
    by_language = [full[labels[full] == k] for k in range(len(names))]
    by_language = [x for x in by_language if len(x)]
    rng = np.random.default_rng(how.seed)
    moments = [[np.zeros_like(a), np.zeros_like(a)] for a in net.arrays()]
    each = max(1, how.batch // len(by_language))
    for step in range(1, how.steps + 1):
        pick = np.concatenate([rng.choice(x, each) for x in by_language])
        _, grads = gradients(net, rows[:, pick], labels[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = how.rate * min(1.0, 2 * (1 - step / (how.steps + 1)))
        for a, g, (m, v) in zip(net.arrays(), grads, moments, strict=True):
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def document_probabilities(
    net: Network, texts: list[bytes], window: int = 96, rows_at_once: int = 2048
) -> np.ndarray:
    """Mean probabilities over all bytes of each text (one row per text)."""
    rows, held, first = byte_rows(texts, window)
    sums = np.empty((rows.shape[1], len(net.languages)))
    places = np.arange(window)[:, None]
    for at in range(0, rows.shape[1], rows_at_once):
        part, n = rows[:, at : at + rows_at_once], held[at : at + rows_at_once]
        p = byte_probabilities(net, read_states(net, part.astype(np.intp))[0])
        short = np.flatnonzero(n < window)
        p[:, short] *= (places < n[short])[:, :, None]
        sums[at : at + rows_at_once] = p.sum(axis=0)
    total = np.add.reduceat(sums, first, axis=0)
    return total / np.maximum([[len(t)] for t in texts], 1)


def held_out(doc_id=None):
    """Documents that must not be learnt from."""
    return F.crc32((F.col("doc_id") if doc_id is None else doc_id).cast("string").cast("binary")) % 4 == 2


def sample(docs: DataFrame, how: Training = Training()) -> tuple[list[str], list[str]]:
    """Excerpts and languages of at most ``how.docs`` documents that may be learnt from.

    Documents are taken by the hash of their id and text, as many of each language as the bound
    allows; rows that are equal in both count as they come, so copies without ids are few at most
    if the source is not made of them.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(), F.lit(False))
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("_order"))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    each = max(1, how.docs // len(counts))
    # Enough for the bound in expectation twice over; what is too much is cut by hash below.
    scale = float(1 << 63)
    limits = {lang: min(1.0, 2 * each / n) * 2 * scale - scale for lang, n in counts.items()}
    near = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    excerpts = F.array(
        *[
            F.substring("text", (F.length("text") * k / how.parts + 1).cast("int"), F.lit(how.window))
            for k in range(how.parts)
        ]
    )
    rows = usable.where(F.col("_order").cast("double") <= near).select("lang", "_order", excerpts.alias("parts"))
    taken: dict[str, int] = {}
    texts, languages = [], []
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["_order"], r["parts"])):
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= each:
            texts += row["parts"]
            languages += [row["lang"]] * len(row["parts"])
    return texts, languages


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred and score of every row: the language with the largest mean probability.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if the network
    knows no language. Null ids and repeated rows stay; other columns are ignored.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            told = [i for i, t in enumerate(texts) if net.languages and has_letter(t)]
            if told:
                p = document_probabilities(net, [texts[i].encode() for i in told])
                for i, k, row in zip(told, p.argmax(axis=1), p, strict=True):
                    names[i], scores[i] = net.languages[k], min(1.0, float(row[k]))
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"])
    return rows.mapInArrow(of, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """Trains on the documents that may be learnt from and predicts all of them.

    Sampling and training run while the query is built.
    """
    texts, languages = sample(docs, how)
    net = train(texts, languages, how) if texts else Network([], *new_network(["x"], 1, 0).arrays())
    return predict(docs, net)
