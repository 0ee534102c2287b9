"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
encoded by how classes of bytes follow each other and how its words repeat;
a learned layer, learned gated attention over the passages
(``softmax(w . (tanh(V h) * sigmoid(U h)))``) and a logistic unit on the
weighted passage representation give the document's score.  Only document
labels are needed: the attention learns which passages decide.

The model (some 10,000 numbers) is trained on the driver from a bounded
sample of labelled documents and travels to the executors inside the scoring
function.  Scoring is a scan: it reads every passage of every text and
shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage, free_names, split_words

PASSAGE_WORDS = 64
CHUNK = 1 << 20  # bytes that are encoded at a time
HIDDEN, GATE = 32, 16

# Classes of bytes.
_KINDS = [
    b" \t\x0b\x0c\r",
    b"\n",
    bytes(range(0x61, 0x7B)),
    bytes(range(0x41, 0x5B)),
    b"0123456789",
    b".",
    b",;:",
    b"!?",
    b"'\"()-",
    b"#*$%&@",
    b"|<>",
    b"[]{}/\\^_`~+=",
    bytes(range(0xC0, 0x100)),
    bytes(range(0x80, 0xC0)),
]
N_KINDS = 16
_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _members in enumerate(_KINDS):
    _CLASS[list(_members)] = _i + 1
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
WIDTH = N_KINDS * N_KINDS + 3


def _encode_chunk(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, dtype=np.uint8)
    kinds, inside = _CLASS[raw].astype(np.int64), _IN_WORD[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    passage = np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE_WORDS
    n = int(passage[-1]) + 1
    width = N_KINDS * N_KINDS
    code = passage[1:] * width + kinds[:-1] * N_KINDS + kinds[1:]
    counts = np.bincount(code, minlength=n * width).reshape(n, width)
    rows = np.empty((n, WIDTH), dtype=np.float32)
    rows[:, :width] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    words = text.split()
    for i in range(n):
        own = words[i * PASSAGE_WORDS : (i + 1) * PASSAGE_WORDS]
        size = max(len(own), 1)
        rows[i, width:] = len(set(own)) / size, sum(map(eq, own, own[1:])) / size, len(own) / PASSAGE_WORDS
    return rows


def encode(text: bytes) -> Iterator[np.ndarray]:
    """Blocks of passage rows; a long text is cut at white space, about ``CHUNK`` bytes each."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + CHUNK) if at + CHUNK < len(text) else None
        end = cut.end() if cut else len(text)
        yield _encode_chunk(text[at:end])
        at = end
    if not text:
        yield np.zeros((1, WIDTH), dtype=np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Gated-attention multiple-instance model on passage rows."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        self.mean, self.spread = mean.astype(np.float64), spread.astype(np.float64)
        self.p = {
            "W": draw.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)),
            "b": np.zeros(HIDDEN),
            "V": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
            "U": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
            "w": draw.normal(0, 1 / np.sqrt(GATE), GATE),
            "c": draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            "d": np.zeros(1),
        }

    def passages(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Standardised rows, hidden vectors, both gates and attention logits."""
        p = self.p
        x = (rows - self.mean) / self.spread
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return x, h, t, g, (t * g) @ p["w"]

    def score(self, blocks: Iterator[np.ndarray]) -> float:
        """The document's probability of label 1; the softmax runs over blocks of passages."""
        top, mass, z = -np.inf, 0.0, np.zeros(HIDDEN)
        for rows in blocks:
            _, h, _, _, e = self.passages(rows)
            high = max(top, float(e.max()))
            weight, keep = np.exp(e - high), np.exp(top - high)
            mass, z, top = mass * keep + weight.sum(), z * keep + weight @ h, high
        return float(_sigmoid(z / mass @ self.p["c"] + self.p["d"][0]))

    def gradients(self, rows: np.ndarray, bag: np.ndarray, n: int, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss over ``n`` bags; ``bag`` gives each row's bag, in order."""
        p = self.p
        x, h, t, g, e = self.passages(rows)
        first = np.searchsorted(bag, np.arange(n))
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        err = (_sigmoid(z @ p["c"] + p["d"][0]) - y) * w / w.sum()
        dz = err[:, None] * p["c"]
        da = (h * dz[bag]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        ds = dh * (1 - h * h)
        return {
            "W": x.T @ ds,
            "b": ds.sum(axis=0),
            "V": h.T @ dt,
            "U": h.T @ dg,
            "w": (t * g).T @ de,
            "c": z.T @ err,
            "d": np.array([err.sum()]),
        }


def train(
    bags: list[np.ndarray], y: np.ndarray, w: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.003, seed: int = 7
) -> AttentionModel:
    """Adam on shuffled batches of bags; the same bags always give the same model."""
    every = np.concatenate(bags)
    model = AttentionModel(every.mean(axis=0), every.std(axis=0) + 0.01, seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    draw, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = draw.permutation(len(bags))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            bag = np.repeat(np.arange(len(pick)), [len(bags[j]) for j in pick])
            grads = model.gradients(np.concatenate([bags[j] for j in pick]), bag, len(pick), y[pick], w[pick])
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * model.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _bag(text: bytes) -> bytes:
    """All passage rows of a training document."""
    return np.concatenate(list(encode(text))).astype(np.float16).tobytes()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    sample_docs: int = 4000,
    sample_passages: int = 64,
) -> AttentionModel | None:
    """The model learned from ``labels`` (``id_col``, ``label_col`` 0/1); None where no labelled document exists.

    At most ``sample_docs`` labelled documents are used, half of them of
    either label where there are enough (those with the smallest hash of
    their id), with all their passages.  Where these are more than
    ``sample_passages`` a document on average, fewer documents are taken, but
    one of either label at least; weights restore the shares of the labels
    among all labelled documents.  This bounds what reaches the driver to
    ``sample_docs * sample_passages`` rows of 259 two-byte numbers, 133 MB
    for the defaults, unless a single document has half of that.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("lid"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
        .join(docs.select(F.col(id_col).alias("did")), F.col("lid") == F.col("did"), "left_semi")
    )
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    order = [F.xxhash64("lid"), F.col("lid")]
    picks = [known.where(F.col("y") == label).orderBy(*order).limit(sample_docs // 2) for label in sorted(totals)]
    chosen = picks[0].unionAll(picks[1]) if len(picks) > 1 else picks[0]

    @F.pandas_udf("binary")
    def bag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_bag(bytes(t)) for t in texts])

    texts = cut_lineage(
        docs.select(F.col(id_col).alias("did"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
        .join(F.broadcast(chosen), F.col("lid") == F.col("did"))
        .groupBy("lid", "y")
        .agg(F.min("text").alias("text"))
        .withColumn("h", F.xxhash64("lid"))
    )
    # Every block of encode() can end with a passage that is not full.
    passages = F.ceil(F.size(split_words(F.col("text").cast("string"))) / PASSAGE_WORDS) + F.floor(F.octet_length("text") / CHUNK)
    room, last = dict.fromkeys(totals, sample_docs * sample_passages // 2), {}
    for r in sorted(texts.select("y", "h", F.greatest(passages, F.lit(1)).alias("n")).collect(), key=lambda r: r["h"]):
        room[r["y"]] -= r["n"]
        if room[r["y"]] >= 0 or r["y"] not in last:
            last[r["y"]] = r["h"]
    within = F.lit(False)
    for label, h in last.items():
        within |= (F.col("y") == label) & (F.col("h") <= h)
    found = texts.where(within).select("lid", "y", bag("text").alias("rows")).toPandas().sort_values("lid")
    bags = [np.frombuffer(r, dtype=np.float16).reshape(-1, WIDTH).astype(np.float32) for r in found["rows"]]
    y = found["y"].to_numpy(dtype=np.float64)
    share = {label: n / max((y == label).sum(), 1) for label, n in totals.items()}
    return train(bags, y, np.array([share[int(v)] for v in y]))


def fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    """The document's fold; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    threshold: float = 0.3,
    **bounds: int,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    The model learns from the labels of documents outside fold 0 and from
    nothing but their texts.

    Defined cases: null and empty texts are one passage of zeros; a text of
    any length is scored over all its passages, block by block; a score that
    equals the threshold is accepted; where rows repeat an id with other
    texts, the model learns from the smallest of them; repeated
    labels of a document count by their mean, null labels and ids not at
    all; a null id is not held out; without any label every score is 0.5.
    Repeated rows score alike; input columns with the names of results are
    replaced; an empty table gives an empty result.
    """
    model = fit(docs, labels.where(fold(id_col) != 0), text_col, id_col, label_col, **bounds)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(encode(bytes(t))) for t in texts], dtype="float64")

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    (value,) = free_names(docs, "_value")
    out = docs.withColumn(value, score(text) if model else F.lit(0.5)).withColumns(
        {"held_out": F.coalesce(fold(id_col) == 0, F.lit(False)), "score": F.col(value)}
    )
    return out.withColumn("predicted", (F.col(value) >= threshold).cast("int")).drop(value)
