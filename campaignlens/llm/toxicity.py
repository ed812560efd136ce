"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is an embedding of the word (for words of the training vocabulary) next to the summed embeddings of
its character trigrams, scaled by the root of their number. A text is cut into overlapping windows; every window is read in both directions, its states are
pooled by attention and give one probability. A text's score is that of its most toxic window.

Labels are per text, so training learns from windows: first those of toxic texts with the words or word
beginnings and endings that occur mostly in toxic texts, then those that the network itself finds most toxic; clean texts give random windows first and
their highest-scored ones later.

Defined results: a null or empty text, or one without words, has score 0; without labels of both classes every score is
0; repeated rows score alike; texts with several labels are taken once per label; an empty table gives an empty
result; other columns are ignored.

Scale: training takes a bounded sample (``TRAINING_TEXTS`` per class of at most ``TRAINING_CHARS`` characters), drawn by
seeded hash over all labels; the model is a few megabytes and travels with the task. Scoring covers whole
texts in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from campaignlens.llm.common import text_bytes

TRAINING_TEXTS = 1500
TRAINING_CHARS = 20_000
WINDOW = 32
STRIDE = 24
TOXIC_AT = 0.7
SEED = 42
EPOCHS = 6
VOCABULARY = 20_000
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTENTION = 12, 8, 8, 8
TRIGRAM_BUCKETS = 4096
_BATCH = 128
_WINDOWS_AT_ONCE = 1024
_CACHED_WORDS = 300_000
_WORDS_AT_ONCE = 20_000
_EDGES = b".,!?;:|\"'()[]{}#*$%&<>-"


def _normal(words: list[bytes]) -> list[bytes]:
    return [w.strip(_EDGES) or w for w in words]


def _affixes(word: bytes) -> list[bytes]:
    """The marked word and its first and last three to six bytes."""
    marked = b"<" + word + b">"
    return [marked, *[marked[:k] for k in range(4, 8)], *[marked[-k:] for k in range(4, 8)]]


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all words between boundary marks, and the word each belongs to."""
    flat = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    number = np.repeat(np.arange(len(words)), lengths)
    same = number[:-2] == number[2:]
    code = (flat[:-2] * 961 + flat[1:-1] * 31 + flat[2:]) * 2654435761 >> 7
    return (code % TRIGRAM_BUCKETS)[same], number[:-2][same]


@dataclass
class Network:
    """Vocabulary and parameters."""

    vocabulary: dict[bytes, int]
    parameters: dict[str, np.ndarray]

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Word and character inputs of normalized words."""
        p = self.parameters
        number = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        buckets, owner = _trigrams(words)
        counts = np.sqrt(np.maximum(np.bincount(owner, minlength=len(words)), 1))[:, None]
        sums = np.zeros((len(words), CHAR_SIZE), np.float32)
        if len(owner):
            firsts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sums[owner[firsts]] = np.add.reduceat(p["chars"][buckets], firsts)
        return np.concatenate([p["words"][number], sums / counts], axis=1, dtype=np.float32)

    def projected(self, words: list[bytes]) -> np.ndarray:
        """Input part of all gates of both directions, computed slice by slice."""
        p = self.parameters
        out = np.empty((len(words), 6 * HIDDEN), np.float32)
        for at in range(0, len(words), _WORDS_AT_ONCE):
            x = self.inputs(words[at : at + _WORDS_AT_ONCE])
            out[at : at + _WORDS_AT_ONCE] = np.concatenate([x @ p["fx"] + p["fb"], x @ p["bx"] + p["bb"]], axis=1)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(gates: np.ndarray, mask: np.ndarray, weights: np.ndarray, backward: bool, keep: list | None = None) -> np.ndarray:
    """States of one direction: gates is (windows, time, 3 * hidden), mask (windows, time)."""
    n, time, _ = gates.shape
    states = np.empty((n, time, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    for t in range(time - 1, -1, -1) if backward else range(time):
        x, hp, m = gates[:, t], h @ weights, mask[:, t, None]
        zr = _sigmoid(x[:, : 2 * HIDDEN] + hp[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN :] + r * hp[:, 2 * HIDDEN :])
        new = m * ((1 - z) * c + z * h) + (1 - m) * h
        if keep is not None:
            keep.append((t, h, z, r, c, hp[:, 2 * HIDDEN :], m))
        states[:, t] = h = new
    return states


def _pool(states: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray]):
    hidden = np.tanh(states @ p["aw"] + p["ab"])
    energy = np.where(mask > 0, hidden @ p["av"], np.float32(-1e9))
    weight = np.exp(energy - energy.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", weight, states)
    return hidden, weight, pooled, pooled @ p["ow"] + p["ob"][0]


def window_index(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word positions (windows, time), mask and text number of all overlapping windows of consecutive texts."""
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = (np.cumsum(lengths) - lengths)[text]
    place = nth[:, None] * STRIDE + np.arange(WINDOW)
    mask = place < lengths[text][:, None]
    return first[:, None] + np.minimum(place, lengths[text][:, None] - 1), mask, text


def window_scores(network: Network, gates: np.ndarray, rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of each window; ``gates`` holds distinct words, ``rows`` the windows' words in it."""
    p = network.parameters
    out = np.empty(len(rows), np.float32)
    for at in range(0, len(rows), _WINDOWS_AT_ONCE):
        part = gates[rows[at : at + _WINDOWS_AT_ONCE]]
        m = mask[at : at + _WINDOWS_AT_ONCE].astype(np.float32)
        states = np.concatenate(
            [_read(part[:, :, : 3 * HIDDEN], m, p["fh"], False), _read(part[:, :, 3 * HIDDEN :], m, p["bh"], True)], axis=2
        )
        out[at : at + _WINDOWS_AT_ONCE] = _sigmoid(_pool(states, m, p)[3])
    return out


def _gradients(network: Network, words: list[list[bytes]], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean logistic loss over windows given as lists of normalized words."""
    p = network.parameters
    flat = [w for ws in words for w in ws]
    distinct = list(dict.fromkeys(flat))
    row = {w: i for i, w in enumerate(distinct)}
    x = network.inputs(distinct)
    index = np.zeros((len(words), WINDOW), np.int64)
    mask = np.zeros((len(words), WINDOW), np.float32)
    for i, ws in enumerate(words):
        index[i, : len(ws)] = [row[w] for w in ws]
        mask[i, : len(ws)] = 1
    kept_f: list = []
    kept_b: list = []
    gates = np.concatenate([x @ p["fx"] + p["fb"], x @ p["bx"] + p["bb"]], axis=1)[index]
    states = np.concatenate(
        [_read(gates[:, :, : 3 * HIDDEN], mask, p["fh"], False, kept_f), _read(gates[:, :, 3 * HIDDEN :], mask, p["bh"], True, kept_b)], axis=2
    )
    hidden, weight, pooled, logit = _pool(states, mask, p)
    g: dict[str, np.ndarray] = {}
    d = ((_sigmoid(logit) - labels) / len(words)).astype(np.float32)
    g["ow"], g["ob"] = pooled.T @ d, np.array([d.sum()], np.float32)
    d_pooled = d[:, None] * p["ow"]
    d_states = weight[:, :, None] * d_pooled[:, None]
    d_weight = np.einsum("nh,nth->nt", d_pooled, states)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    g["av"] = np.einsum("nt,nta->a", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * p["av"] * (1 - hidden**2)
    g["aw"], g["ab"] = np.einsum("nth,nta->ha", states, d_hidden), d_hidden.sum(axis=(0, 1))
    d_states = d_states + d_hidden @ p["aw"].T
    d_gates = np.zeros_like(gates)
    for name, kept, low in (("f", kept_f, 0), ("b", kept_b, 3 * HIDDEN)):
        weights, d_weights = p[f"{name}h"], np.zeros_like(p[f"{name}h"])
        d_h = np.zeros((len(words), HIDDEN), np.float32)
        part = d_states[:, :, HIDDEN:] if low else d_states[:, :, :HIDDEN]
        for t, h, z, r, c, hc, m in reversed(kept):
            d_h = d_h + part[:, t]
            d_new = d_h * m
            d_c = d_new * (1 - z) * (1 - c**2)
            d_z = d_new * (h - c) * z * (1 - z)
            d_r = d_c * hc * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_c], axis=1)
            d_hp = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_gates[:, t, low : low + 3 * HIDDEN] = d_x
            d_weights += h.T @ d_hp
            d_h = d_h * (1 - m) + d_new * z + d_hp @ weights.T
        g[f"{name}h"] = d_weights
    by_word = np.zeros((len(distinct), 6 * HIDDEN), np.float32)
    np.add.at(by_word, index[mask > 0], d_gates[mask > 0])
    forward, backward = by_word[:, : 3 * HIDDEN], by_word[:, 3 * HIDDEN :]
    g["fx"], g["fb"], g["bx"], g["bb"] = x.T @ forward, forward.sum(axis=0), x.T @ backward, backward.sum(axis=0)
    d_x = forward @ p["fx"].T + backward @ p["bx"].T
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], [network.vocabulary.get(w, 0) for w in distinct], d_x[:, :WORD_SIZE])
    buckets, owner = _trigrams(distinct)
    counts = np.sqrt(np.maximum(np.bincount(owner, minlength=len(distinct)), 1))
    g["chars"] = np.zeros_like(p["chars"])
    np.add.at(g["chars"], buckets, (d_x[:, WORD_SIZE:] / counts[:, None])[owner])
    return g


def _initial(vocabulary: dict[bytes, int], rng: np.random.Generator) -> dict[str, np.ndarray]:
    size = WORD_SIZE + CHAR_SIZE
    shapes = {
        "words": (len(vocabulary) + 1, WORD_SIZE), "chars": (TRIGRAM_BUCKETS, CHAR_SIZE), "fx": (size, 3 * HIDDEN), "bx": (size, 3 * HIDDEN),
        "fh": (HIDDEN, 3 * HIDDEN), "bh": (HIDDEN, 3 * HIDDEN), "aw": (2 * HIDDEN, ATTENTION), "av": (ATTENTION,), "ow": (2 * HIDDEN,),
    }
    made = {k: (rng.standard_normal(s) * (0.1 if k in ("words", "chars") else s[0] ** -0.5)).astype(np.float32) for k, s in shapes.items()}
    zeros = {"fb": 3 * HIDDEN, "bb": 3 * HIDDEN, "ab": ATTENTION, "ob": 1}
    return made | {k: np.zeros(n, np.float32) for k, n in zeros.items()}


def _evidence(names: list[bytes], distinct: list[np.ndarray], labels: list[int]) -> np.ndarray:
    """Per word the strongest evidence of its affixes: how far the toxic texts that hold an affix exceed the share
    of toxic texts, in standard deviations. ``distinct`` has the word numbers of each text."""
    import xxhash

    each = len(_affixes(b""))
    made = (xxhash.xxh64_intdigest(a) for w in names for a in _affixes(w))
    hashes = np.fromiter(made, np.uint64, each * len(names)).reshape(-1, each)
    kinds, affixes = np.unique(hashes, return_inverse=True)
    affixes = affixes.reshape(hashes.shape).astype(np.int32)
    held, toxic = np.zeros(len(kinds)), np.zeros(len(kinds))
    for words, y in zip(distinct, labels, strict=True):
        found = np.unique(affixes[words])
        held[found] += 1
        toxic[found] += y
    share = sum(labels) / len(labels)
    return ((toxic - held * share) / np.sqrt(held * share * (1 - share) + 1))[affixes].max(axis=1)


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network | None:
    """Trains on whole labelled texts; none if a class is missing. Same sample, same network.

    Texts are held as numbers of their words; memory follows the sample's bytes and distinct words.
    """
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    number: dict[bytes, int] = {}
    split = [np.array([number.setdefault(w, len(number)) for w in _normal(t.lower().split())], np.int32) for t in texts]
    names = list(number)
    del number
    distinct = [np.unique(ws) for ws in split]
    found = np.bincount(np.concatenate(distinct), minlength=len(names)) if names else np.zeros(0, np.int64)
    common = sorted(np.flatnonzero(found >= 3).tolist(), key=lambda i: (-found[i], names[i]))[:VOCABULARY]
    network = Network({names[i]: n for n, i in enumerate(common, start=1)}, {})
    p = network.parameters = _initial(network.vocabulary, rng)
    evidence = _evidence(names, distinct, labels) if names else np.zeros(0)
    lengths = np.array([len(ws) for ws in split])
    places, mask, text = window_index(lengths)
    if not len(text):
        return network
    rows = np.concatenate(split)[places]
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        mined = epoch >= 2
        if mined:
            value = window_scores(network, network.projected(names), rows, mask)
        else:
            toxic = np.array(labels)[text] == 1
            value = np.where(toxic, np.where(mask, evidence[rows], -np.inf).max(axis=1), rng.random(len(text)))
        chosen: list[int] = []
        for i, y in enumerate(labels):
            low, high = bounds[i], bounds[i + 1]
            best = low + np.argsort(-value[low:high], kind="stable")
            chosen += best[: 1 if y else 3].tolist()
            if not y and mined and high > low:
                chosen.append(int(rng.integers(low, high)))
        order = rng.permutation(chosen)
        rate = 0.01 if epoch < epochs - 2 else 0.003
        for at in range(0, len(order), _BATCH):
            batch = order[at : at + _BATCH]
            words = [[names[j] for j in rows[w][mask[w]]] for w in batch]
            gradients = _gradients(network, words, np.array(labels, np.float32)[text[batch]])
            step += 1
            for k, gradient in gradients.items():
                first, second = moments[k]
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                p[k] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return network


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAINING_TEXTS, max_chars: int = TRAINING_CHARS) -> tuple[list[bytes], list[int]]:
    """About ``per_class`` labelled texts of each class, drawn by hash of the id over all ``(doc_id, toxic)``.

    Only the drawn ids, bounded by the parameter, are broadcast to the texts.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return [], []
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / counts[1])).otherwise(min(1.0, per_class / counts[0]))
    drawn = known.filter(draw < share).limit(4 * per_class)
    short = docs.filter(F.char_length("text") <= max_chars).select("doc_id", "text")
    rows = short.join(F.broadcast(drawn), "doc_id").collect()
    pairs = sorted((r["doc_id"], r["toxic"], r["text"]) for r in rows)
    return [t.encode() for _, _, t in pairs], [int(y) for _, y, _ in pairs]


class _Words:
    """Distinct words met by a worker and their gates, for one network."""

    def __init__(self, network: Network):
        self.network = network
        self.rows: dict[bytes, int] = {}
        self.gates = np.empty((1024, 6 * HIDDEN), np.float32)

    def learn(self, texts: list[list[bytes]]) -> None:
        new = {w for words in texts for w in words if w not in self.rows}
        if len(self.rows) + len(new) > _CACHED_WORDS:
            self.rows = {}
            new = {w for words in texts for w in words}
        if new:
            first, names = len(self.rows), list(new)
            while len(self.gates) < first + len(names):
                self.gates = np.concatenate([self.gates, np.empty_like(self.gates)])
            self.gates[first : first + len(names)] = self.network.projected(_normal(names))
            self.rows.update(zip(names, range(first, first + len(names)), strict=True))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def scored(docs: DataFrame, network: Network | None) -> DataFrame:
    """``(doc_id, score)`` of every whole text: its most toxic window's probability."""
    import pyarrow as pa

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(network) if network else None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                best = np.zeros(batch.num_rows)
                if known is not None:
                    texts = [t.lower().split() for t in text_bytes(batch.column(1))]
                    known.learn(texts)
                    lengths = np.array([len(t) for t in texts])
                    rows = np.fromiter((known.rows[w] for t in texts for w in t), np.int64, lengths.sum())
                    places, mask, text = window_index(lengths)
                    for low in range(0, len(text), 65536):
                        part = slice(low, low + 65536)
                        np.maximum.at(best, text[part], window_scores(network, known.gates, rows[places[part]], mask[part]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best)], SCHEMA.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(score, SCHEMA)
