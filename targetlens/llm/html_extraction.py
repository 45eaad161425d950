"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.llm.html_blocks import Block, leaf_blocks, template_pages

#: Labelled pages on which the field is fitted, at most.
TRAINING_PAGES = 600
ROUNDS = 200
PENALTY = 1e-3


def block_features(block: Block, place: int) -> list[str]:
    """Names of the features that hold: ancestors, hints, length, links, ending."""
    words = block.text.count(" ") + 1
    density = block.link_chars / len(block.text)
    size = next(name for top, name in ((2, "2"), (5, "5"), (10, "10"), (25, "25"), (60, "60"), (float("inf"), "long")) if words <= top)
    out = ["bias", *block.context, f"words:{size}", f"links:{'none' if not density else 'some' if density < 0.5 else 'most'}"]
    out.append("ends" if block.text[-1] in ".!?:;…\"'”»)" else "open")
    if place == 0:
        out.append("first")
    if "©" in block.text:
        out.append("sign")
    return out


@dataclass
class Field:
    """Weights of label 1 (main) against label 0 by feature, and of the transitions."""

    weights: dict[str, float]
    start: np.ndarray
    steps: np.ndarray

    def decode(self, blocks: Sequence[Block]) -> list[int]:
        """Most probable labels of all blocks together, by Viterbi."""
        if not blocks:
            return []
        weights, (s00, s01, s10, s11) = self.weights, self.steps.ravel().tolist()
        back, best0, best1 = [], float(self.start[0]), float(self.start[1])
        for place, block in enumerate(blocks):
            score = sum([weights.get(f, 0.0) for f in block_features(block, place)])
            if place:
                from0 = (best0 + s00 >= best1 + s10, best0 + s01 >= best1 + s11)
                best0, best1 = max(best0 + s00, best1 + s10), max(best0 + s01, best1 + s11)
                back.append(from0)
            best1 += score
        label = int(best1 > best0)
        labels = [label]
        for from0 in reversed(back):
            label = 0 if from0[label] else 1
            labels.append(label)
        return labels[::-1]


def label_blocks(blocks: Sequence[Block], main: Sequence[str]) -> list[int]:
    """1 for the blocks whose texts are the main ones, matched in page order."""
    wanted, at, out = [" ".join(m.split()) for m in main], 0, []
    for block in blocks:
        hit = at < len(wanted) and block.text == wanted[at]
        out.append(int(hit))
        at += hit
    return out


def fit(labelled: Sequence[tuple[str, Sequence[str]]]) -> Field:
    """Maximum penalised likelihood on labelled pages, by forward-backward and Adam steps.

    A page's chain is padded to the longest one and its padding masked, so every step of the
    recursion serves all pages at once.
    """
    chains = [(b, label_blocks(b, main)) for b, main in ((leaf_blocks(h), m) for h, m in labelled) if b]
    names: dict[str, int] = {}
    rows, cols, place_of = [], [], []
    longest = max(len(b) for b, _ in chains)
    gold = np.zeros((len(chains), longest), dtype=int)
    mask = np.zeros((len(chains), longest), dtype=bool)
    for page, (blocks, labels) in enumerate(chains):
        for place, block in enumerate(blocks):
            for name in block_features(block, place):
                rows.append(len(place_of))
                cols.append(names.setdefault(name, len(names)))
            gold[page, place], mask[page, place] = labels[place], True
            place_of.append(page * longest + place)
    x = np.zeros((len(place_of), len(names)))
    x[rows, cols] = 1.0
    theta = np.zeros(len(names) + 6)  # feature weights, two starts, four transitions
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        gradient = _gradient(theta, x, np.array(place_of), gold, mask)
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        theta = theta + 0.1 * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    n = len(names)
    return Field({k: float(theta[i]) for k, i in names.items()}, theta[n:n + 2], theta[n + 2:].reshape(2, 2))


def _gradient(theta: np.ndarray, x: np.ndarray, place_of: np.ndarray, gold: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Gradient of the mean log-likelihood less the penalty."""
    n_pages, longest = gold.shape
    n = x.shape[1]
    start, steps = theta[n:n + 2], theta[n + 2:].reshape(2, 2)
    unary = np.zeros((n_pages * longest, 2))
    unary[place_of, 1] = x @ theta[:n]
    unary = unary.reshape(n_pages, longest, 2)
    # products kept in range by dividing each place by its sum; the padding passes values on
    emit = np.exp(unary - unary.max(axis=2, keepdims=True)).transpose(1, 0, 2).copy()
    move, valid = np.exp(steps), mask.T[:, :, None]
    forward, backward = np.zeros_like(emit), np.ones_like(emit)
    scale = np.ones((longest, n_pages, 1))
    forward[0] = np.exp(start) * emit[0]
    for t in range(longest):
        if t:
            forward[t] = np.where(valid[t], (forward[t - 1] @ move) * emit[t], forward[t - 1])
        scale[t] = forward[t].sum(axis=1, keepdims=True)
        forward[t] /= scale[t]
    for t in range(longest - 2, -1, -1):
        moved = (emit[t + 1] * backward[t + 1]) @ move.T / scale[t + 1]
        backward[t] = np.where(valid[t + 1], moved, 1.0)
    single = (forward * backward * valid).transpose(1, 0, 2)
    pairs = (
        forward[:-1, :, :, None] * move * (emit * backward / scale)[1:, :, None, :] * valid[1:, :, :, None]
    ).transpose(1, 0, 2, 3)
    error = (gold - single[:, :, 1]).reshape(-1)[place_of]
    out = np.zeros_like(theta)
    out[:n] = error @ x
    out[n] = (gold[:, 0] == 0).sum() - single[:, 0, 0].sum()
    out[n + 1] = (gold[:, 0] == 1).sum() - single[:, 0, 1].sum()
    for a in range(2):
        for b in range(2):
            seen = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & mask[:, 1:]).sum()
            out[n + 2 + 2 * a + b] = seen - pairs[:, :, a, b].sum()
    return out / n_pages - PENALTY * theta


def fit_on_table(labelled: DataFrame, html_col: str = "html", main_col: str = "main") -> Field:
    """``fit`` on at most TRAINING_PAGES rows, those of the smallest hash; ``main`` is an array of blocks."""
    rows = (
        labelled.where(F.col(html_col).isNotNull() & F.col(main_col).isNotNull())
        .orderBy(F.xxhash64(html_col), html_col).limit(TRAINING_PAGES).select(html_col, main_col).collect()
    )
    return fit([(r[0], r[1]) for r in rows])


def main_text(page: str | None, model: Field) -> str:
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, model.decode(blocks)) if keep)


def extract_main_text(
    pages: DataFrame, model: Field | None = None, html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """``pages`` with ``text_col`` added: the main blocks in page order, joined by two line ends.

    Without a model the field is fitted first on labelled pages rendered from templates. A NULL or
    empty page, and one without main blocks, gives an empty text. Repeated rows each keep their
    row; an empty table gives none; other columns are kept, one named ``text_col`` is replaced.
    """
    model = model or fit(template_pages(TRAINING_PAGES))
    rest = [c for c in pages.columns if c != text_col]
    at = rest.index(html_col)
    schema = T.StructType([pages.schema[c] for c in rest] + [T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), model) for h in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*rest, text_col])

    return pages.select(*rest).mapInArrow(run, schema)
