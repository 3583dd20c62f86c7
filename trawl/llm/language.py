"""Language of a text by a byte convolutional network trained in numpy.

Byte embeddings, filters of several widths, max pooling over fixed-length windows of the
UTF-8 bytes, softmax. A convolution over embedded bytes is a sum of table rows, so a
window is scored by gathers on byte pairs. Every window of a text counts, in proportion to
its bytes.

Defined cases: null text, empty text and text without a letter are ``und`` with score 0;
without any labelled text everything is ``und``; texts of any length are cut into windows
and scored in blocks of bounded size; repeated rows get equal results; other columns pass
through, and columns named like the two added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import bounded_sample, texts_of

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
# Least probability of the language of a document that is kept.
LEAST = 0.5
# Windows scored at once: their activations take about 8 MB.
BLOCK = 256


@dataclass
class ByteNetwork:
    """Weights: ``embed`` (256, e), ``kernels[w]`` (w, e, f), ``bias[w]`` (f), ``out``, ``out_bias``."""

    languages: list[str]
    embed: np.ndarray
    kernels: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def taps(self, width: int) -> list[np.ndarray]:
        return [self.embed @ self.kernels[width][k] for k in range(width)]

    def pair_tables(self) -> dict[int, list[tuple[int, np.ndarray]]]:
        """For each width the (offset, table) gathers; two taps at a time by byte pair."""
        tables = {}
        for width in self.kernels:
            taps, gathers = self.taps(width), []
            for k in range(0, width - 1, 2):
                pair = taps[k][:, None, :] + taps[k + 1][None, :, :]
                gathers.append((k, pair.reshape(65536, -1).astype(np.float32)))
            if width % 2:
                single = np.broadcast_to(taps[-1][:, None, :], (256, 256, taps[-1].shape[1]))
                gathers.append((width - 1, single.reshape(65536, -1).astype(np.float32)))
            tables[width] = gathers
        return tables

    def log_probabilities(self, windows: np.ndarray, tables: dict) -> np.ndarray:
        """(n, WINDOW) bytes to (n, languages) log probabilities."""
        padded = np.zeros((len(windows), windows.shape[1] + 1), dtype=np.int32)
        padded[:, :-1] = windows
        pairs = padded[:, :-1] * 256 + padded[:, 1:]
        pooled = []
        for width, gathers in tables.items():
            span = windows.shape[1] - width + 1
            total = None
            for offset, rows in gathers:
                part = rows.take(pairs[:, offset : offset + span], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(np.maximum(total.max(axis=1) + self.bias[width], 0))
        return log_softmax(np.concatenate(pooled, axis=1) @ self.out + self.out_bias)


def log_softmax(scores: np.ndarray) -> np.ndarray:
    top = scores - scores.max(axis=1, keepdims=True)
    return top - np.log(np.exp(top).sum(axis=1, keepdims=True))


def as_windows(data: bytes, window: int = WINDOW) -> np.ndarray:
    """Bytes as rows of ``window``, the last one filled with zeros."""
    rows = max(1, -(-len(data) // window))
    return np.frombuffer(data.ljust(rows * window, b"\0"), dtype=np.uint8).reshape(rows, window)


def train(
    texts: list[bytes], labels: list[str], epochs: int = 6, filters: int = 12, embedding: int = 8,
    window: int = WINDOW, seed: int = 7, rate: float = 0.01, batch: int = 64,
) -> ByteNetwork:
    """Fit by Adam on one window of each text."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    classes = np.array([languages.index(x) for x in labels])
    windows = np.concatenate([as_windows(t[:window], window) for t in texts])
    weights = {"embed": rng.normal(0, 0.5, (256, embedding)), "out_bias": np.zeros(len(languages))}
    for w in WIDTHS:
        weights[f"kernel{w}"] = rng.normal(0, (2 / (w * embedding)) ** 0.5, (w, embedding, filters))
        weights[f"bias{w}"] = np.zeros(filters)
    weights["out"] = rng.normal(0, 0.3, (filters * len(WIDTHS), len(languages)))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            gradients = _gradients(weights, windows[chosen], classes[chosen])
            step += 1
            for k, g in gradients.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return ByteNetwork(
        languages, weights["embed"], {w: weights[f"kernel{w}"] for w in WIDTHS},
        {w: weights[f"bias{w}"] for w in WIDTHS}, weights["out"], weights["out_bias"],
    )


def _gradients(weights: dict, windows: np.ndarray, classes: np.ndarray) -> dict:
    """Gradients of the cross entropy; max pooling passes them to one place per filter."""
    places, pooled = {}, []
    for w in WIDTHS:
        taps = [weights["embed"] @ weights[f"kernel{w}"][k] for k in range(w)]
        span = windows.shape[1] - w + 1
        total = sum(taps[k][windows[:, k : k + span]] for k in range(w))
        places[w] = total.argmax(axis=1)
        pooled.append(np.take_along_axis(total, places[w][:, None, :], axis=1)[:, 0] + weights[f"bias{w}"])
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    probability = np.exp(log_softmax(hidden @ weights["out"] + weights["out_bias"]))
    probability[np.arange(len(classes)), classes] -= 1
    probability /= len(classes)
    grads = {"out": hidden.T @ probability, "out_bias": probability.sum(0), "embed": np.zeros_like(weights["embed"])}
    back = (probability @ weights["out"].T) * (raw > 0)
    filters = weights[f"bias{WIDTHS[0]}"].shape[0]
    for i, w in enumerate(WIDTHS):
        g = back[:, i * filters : (i + 1) * filters]
        grads[f"bias{w}"] = g.sum(0)
        kernel = np.empty_like(weights[f"kernel{w}"])
        for k in range(w):
            seen = np.take_along_axis(windows, places[w] + k, axis=1).astype(np.int64)
            table = np.bincount((seen * filters + np.arange(filters)).ravel(), g.ravel(), 256 * filters).reshape(256, filters)
            kernel[k] = weights["embed"].T @ table
            grads["embed"] += table @ weights[f"kernel{w}"][k].T
        grads[f"kernel{w}"] = kernel
    return grads


def fit(
    docs: DataFrame, key: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 600, windows_per_text: int = 4,
) -> ByteNetwork | None:
    """Train on a bounded sample: ``per_language`` texts, some windows of each.

    Windows start at hashed places anywhere in the text. Only they reach the driver, at
    most ``windows_per_text`` times the window size for each sampled text.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sample = bounded_sample(labelled, key, lang_col, per_language)
    place = lambda i: F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.greatest(F.length(text_col) - WINDOW // 2, F.lit(1))) + 1
    cuts = F.array(*[F.col(text_col).substr(place(i).cast("int"), F.lit(WINDOW)) for i in range(windows_per_text)])
    rows = sample.select(F.col(key).alias("key"), F.col(lang_col).alias("lang"), cuts.alias("cuts")).collect()
    rows.sort(key=lambda r: (str(r.key), r.lang, r.cuts))
    pairs = [(cut.encode()[:WINDOW], r.lang) for r in rows for cut in r.cuts if any(map(str.isalpha, cut))]
    return train([p[0] for p in pairs], [p[1] for p in pairs]) if pairs else None


def score_texts(network: ByteNetwork | None, texts: Iterable, n: int, tables: dict | None) -> tuple[list[str], list[float]]:
    """Predicted language and its probability for each of the ``n`` texts."""
    names, scores = [UNKNOWN] * n, [0.0] * n
    if network is None:
        return names, scores
    waiting: list[tuple[int, np.ndarray, int]] = []
    sums = np.zeros((n, len(network.languages)))
    held = 0

    def flush() -> None:
        nonlocal held
        if not waiting:
            return
        windows = np.concatenate([w for _, w, _ in waiting])
        owners = np.concatenate([np.full(len(w), i) for i, w, _ in waiting])
        sizes = np.concatenate([_sizes(len(w), n) for _, w, n in waiting])
        for at in range(0, len(windows), BLOCK):
            block = np.exp(network.log_probabilities(windows[at : at + BLOCK], tables))
            np.add.at(sums, owners[at : at + BLOCK], block * sizes[at : at + BLOCK, None])
        waiting.clear()
        held = 0

    piece = BLOCK * WINDOW
    for i, text in enumerate(texts):
        if text is None or not any(map(str.isalpha, text)):
            continue
        data = text.encode("utf-8", "replace")
        for at in range(0, len(data), piece):
            part = data[at : at + piece]
            waiting.append((i, as_windows(part), len(part)))
            held += len(waiting[-1][1])
            if held >= BLOCK:
                flush()
    flush()
    totals = sums.sum(axis=1)
    for i in np.flatnonzero(totals > 0):
        best = int(sums[i].argmax())
        names[i], scores[i] = network.languages[best], float(sums[i, best] / totals[i])
    return names, scores


def _sizes(rows: int, n: int) -> np.ndarray:
    sizes = np.full(rows, WINDOW, dtype=np.float64)
    sizes[-1] = n - WINDOW * (rows - 1)
    return sizes


def predict(docs: DataFrame, network: ByteNetwork | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``."""

    @F.arrow_udf("lang_pred string, score double")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = network.pair_tables() if network else None
        for texts in batches:
            names, scores = score_texts(network, texts_of(texts), len(texts), tables)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score") or c == text_col]
    return docs.select(*kept, guess(F.col(text_col)).alias("__guess")).select(*kept, "__guess.lang_pred", "__guess.score")


def keep_identified(docs: DataFrame, network: ByteNetwork | None, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The documents whose language is told with a probability of ``least`` or more.

    Text without a letter is rejected; without a network nothing can be told.
    """
    told = predict(docs.select("*", F.col(text_col).alias("__text")), network, "__text")
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*docs.columns)
