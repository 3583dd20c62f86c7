"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and of the lines beside it.
The marginal probability that a line is good comes from forward-backward; the marginals,
weighted by line length, give the document's share of good text, and a logistic curve
fitted on the training documents turns that share into a probability.

Labels are given for documents only. A line first takes its document's label; then lines
of bad documents that the field finds good are relabelled (the worst line of each bad
document stays bad) and the field is fitted again.

Defined cases: null text counts as empty; an empty text is one empty line and is scored
like any other; without training rows of both labels every score is the share of label 1
(0.5 without rows); repeated rows get equal scores; other columns pass through, and
columns named like the added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import bounded_sample, texts_of

# Bytes of text whose features are computed at once; they take about sixty times as much.
BLOCK_BYTES = 256 << 10
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, HIGH, BREAK = range(8)
CLASSES = np.full(256, SYMBOL, dtype=np.int64)
CLASSES[ord("a") : ord("z") + 1] = LOWER
CLASSES[ord("A") : ord("Z") + 1] = UPPER
CLASSES[ord("0") : ord("9") + 1] = DIGIT
CLASSES[[9, 11, 12, 13, 32]] = SPACE
CLASSES[[ord(c) for c in ".,;:'\"()-?"]] = STOP
CLASSES[128:] = HIGH
CLASSES[10] = BREAK
MULTIPLIER = 0x9E3779B97F4A7C15
BASE = 17
N_FEATURES = 3 * BASE + 1


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, N_FEATURES), bytes of each line, and the number of lines of each text."""
    blob = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kinds = CLASSES[blob]
    breaks = np.flatnonzero(blob == 10)
    starts = np.concatenate([[0], breaks[:-1] + 1])
    lengths = breaks - starts
    n_lines = len(breaks)
    line_of = np.repeat(np.arange(n_lines), lengths + 1)
    counts = np.bincount(line_of * 8 + kinds, minlength=n_lines * 8).reshape(n_lines, 8)[:, :7].astype(float)
    size = np.maximum(lengths, 1)[:, None]

    inside = (kinds != SPACE) & (kinds != BREAK)
    edges = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashes = word_hashes(blob, first, last)
    word_line = line_of[first]
    n_words = np.bincount(word_line, minlength=n_lines)
    repeat = np.zeros(len(first), dtype=bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])
    repeats = np.bincount(word_line, repeat, n_lines)
    placed = np.unique(hashes ^ (word_line.astype(np.uint64) * np.uint64(MULTIPLIER)), return_index=True)[1]
    distinct = np.bincount(word_line[placed], minlength=n_lines)
    bare = np.add.reduceat(np.isin(kinds, (LOWER, UPPER, HIGH)).astype(np.int64), first) == 0 if len(first) else np.zeros(0, bool)
    wordless = np.bincount(word_line, bare, n_lines)

    words = np.maximum(n_words, 1)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH], 1)
    shares = counts / size
    upper, symbols = counts[:, UPPER] / letters, shares[:, SYMBOL]
    own = np.column_stack([
        shares, upper, upper > 0.5, symbols > 0.05, repeats / words, repeats / words > 0.3,
        distinct / words, wordless / words, np.minimum(lengths / words, 40) / 10, np.log1p(lengths) / 5, n_words == 0,
    ])
    per_text = np.array([t.count(b"\n") + 1 for t in texts])
    text_start = np.zeros(n_lines, dtype=bool)
    text_start[np.cumsum(per_text)[:-1]] = True
    text_start[0] = True
    before = np.vstack([np.zeros((1, BASE)), own[:-1]])
    before[text_start] = 0
    after = np.vstack([own[1:], np.zeros((1, BASE))])
    after[np.concatenate([text_start[1:], [True]])] = 0
    return np.hstack([own, before, after, np.ones((n_lines, 1))]), lengths, per_text


def word_hashes(blob: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from differences of one running polynomial."""
    mix = np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER)
    mix ^= mix >> np.uint64(29)
    power = np.cumprod(np.full(len(blob), MULTIPLIER, dtype=np.uint64))
    back = np.cumprod(np.full(len(blob), pow(MULTIPLIER, -1, 1 << 64), dtype=np.uint64))
    running = np.concatenate([[np.uint64(0)], np.cumsum(mix[blob] * power)])
    return (running[last] - running[first]) * (back[first] if len(first) else np.zeros(0, np.uint64))


@dataclass
class LineField:
    """State 1 is good. ``weights`` (features, 2), ``moves`` (2, 2), and the curve to scores."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def marginals(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        return chain_sums(features @ self.weights, self.moves, per_text)[0][:, 1]

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(sum(1 for _ in texts), self.constant)
        out = [self._block(block) for block in text_blocks(texts)]
        return np.concatenate(out) if out else np.zeros(0)

    def _block(self, texts: list[bytes]) -> np.ndarray:
        features, lengths, per_text = line_features(texts)
        share = good_share(self.marginals(features, per_text), lengths, per_text)
        return 1 / (1 + np.exp(-(self.slope * logit(share) + self.shift)))


def text_blocks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``BLOCK_BYTES`` together."""
    block, held = [], 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def logit(share: np.ndarray) -> np.ndarray:
    clipped = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(clipped / (1 - clipped))


def good_share(good: np.ndarray, lengths: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    heads = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    weight = np.maximum(lengths, 1).astype(float)
    return np.add.reduceat(good * weight, heads) / np.add.reduceat(weight, heads)


def chain_sums(scores: np.ndarray, moves: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over all chains at once.

    Returns the state marginals (lines, 2), the expected moves (2, 2), and the sum of the
    chains' log partition functions. Chains are ordered by length, so that the ones still
    running at a step are always the first.
    """
    heads = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    order = np.argsort(-per_text, kind="stable")
    heads, spans = heads[order], per_text[order]
    steps = int(spans[0])
    running = np.searchsorted(-spans, -np.arange(steps), side="left")
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[heads] = scores[heads]
    for t in range(1, steps):
        at = heads[: running[t]] + t
        alpha[at] = scores[at] + np.logaddexp(alpha[at - 1, :1] + moves[0], alpha[at - 1, 1:] + moves[1])
    for t in range(steps - 2, -1, -1):
        at = heads[: running[t + 1]] + t
        ahead = scores[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
    total = np.logaddexp(alpha[heads + spans - 1, 0], alpha[heads + spans - 1, 1])
    per_line = np.empty(len(scores))
    per_line[np.concatenate([np.arange(h, h + s) for h, s in zip(heads, spans)])] = np.repeat(total, spans)
    marginal = np.exp(alpha + beta - per_line[:, None])
    later = np.ones(len(scores), dtype=bool)
    later[heads] = False
    at = np.flatnonzero(later)
    pair = alpha[at - 1][:, :, None] + moves[None] + (scores[at] + beta[at])[:, None, :] - per_line[at][:, None, None]
    return marginal, np.exp(pair).sum(axis=0), float(total.sum())


def fit_field(features: np.ndarray, per_text: np.ndarray, labels: np.ndarray, steps: int = 120, ridge: float = 1e-3) -> LineField:
    """Maximise the likelihood of line labels by Adam on the whole sample."""
    n = len(labels)
    truth = np.column_stack([1 - labels, labels]).astype(float)
    later = np.ones(n, dtype=bool)
    later[np.concatenate([[0], np.cumsum(per_text)[:-1]])] = False
    at = np.flatnonzero(later)
    seen = np.bincount(labels[at - 1] * 2 + labels[at], minlength=4).reshape(2, 2)
    weights, moves = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, moves)]
    for step in range(1, steps + 1):
        marginal, expected, _ = chain_sums(features @ weights, moves, per_text)
        gradients = (features.T @ (marginal - truth) / n + ridge * weights, (expected - seen) / n + ridge * moves)
        for x, g, s in zip((weights, moves), gradients, state):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            x -= 0.15 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    return LineField(weights, moves)


def train(texts: list[bytes], labels: list[int], weight: list[float], rounds: int = 3) -> LineField:
    """Fit the field and the curve from good share to score; ``weight`` undoes sampling."""
    labels_of_text = np.array(labels, dtype=np.int64)
    features, lengths, per_text = (np.concatenate(x) for x in zip(*map(line_features, text_blocks(texts))))
    owner = np.repeat(np.arange(len(texts)), per_text)
    inherited = labels_of_text[owner]
    heads = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    lines, field = inherited.copy(), None
    for _ in range(rounds):
        field = fit_field(features, per_text, lines)
        good = field.marginals(features, per_text)
        worst = np.minimum.reduceat(good, heads)[owner]
        lines = np.where((inherited == 0) & (good > 0.5) & (good > worst), 1, inherited)
    x = logit(good_share(field.marginals(features, per_text), lengths, per_text))
    field.slope, field.shift = fit_curve(x, labels_of_text, np.array(weight))
    return field


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression on one variable by Newton's method."""
    design, w = np.column_stack([x, np.ones_like(x)]), weight / weight.sum()
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (p - y)) + ridge * beta * [1, 0]
        curvature = (design * (w * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        beta -= np.clip(np.linalg.solve(curvature, gradient), -1, 1)
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_label: int = 2000, longest: int = 20_000,
) -> LineField:
    """Train on a bounded sample: about ``per_label`` documents of each label.

    Documents longer than ``longest`` code points are not drawn for training, which bounds
    what the driver holds; they are scored like all others. A document labelled twice has
    the larger label.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label_col).alias("label"))
    totals = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if set(totals) != {0, 1}:
        rows = sum(totals.values())
        return LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), constant=totals.get(1, 0) / rows if rows else 0.5)
    # The sample is bounded, so it may be sent to every task.
    chosen = bounded_sample(marked, key, "label", per_label)
    texts = docs.select(key, F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.length("text") <= longest)
    drawn = texts.join(F.broadcast(chosen), key).groupBy(key).agg(F.max("label").alias("label"), F.max("text").alias("text"))
    rows = sorted(drawn.collect(), key=lambda r: str(r[key]))
    seen = {x: sum(r.label == x for r in rows) for x in (0, 1)}
    if not all(seen.values()):
        return LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), constant=totals[1] / sum(totals.values()))
    return train([r.text.encode("utf-8", "replace") for r in rows], [r.label for r in rows], [totals[r.label] / seen[r.label] for r in rows])


def score(docs: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """Add ``score``, the probability of label 1."""

    @F.arrow_udf("double")
    def quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(field.scores((t or "").encode("utf-8", "replace") for t in texts_of(texts)), pa.float64())

    kept = [c for c in docs.columns if c != "score" or c == text_col]
    return docs.select(*kept, quality(F.col(text_col)).alias("score"))


def keep_good(docs: DataFrame, field: LineField, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a score of ``least`` or more, with their own columns."""
    scored = score(docs.select("*", F.col(text_col).alias("__text")), field, "__text")
    return scored.where(F.col("score") >= least).select(*docs.columns)
