"""Quality scores from two zstandard dictionaries, one of good and one of bad labelled text.

A text is compressed piece by piece under both dictionaries. The normalised difference of the two
compressed sizes, with length as its scale, and the normalised difference of the plain and the
compressed size, which alone shows text that only repeats itself, go through a logistic
calibration fitted on labelled rows that the dictionaries have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import label_sample, mapped, written

#: Labelled rows used for each label value, at most.
PER_LABEL = 3000
#: Bytes of each dictionary and the zstandard level.
DICTIONARY_BYTES, LEVEL = 32 * 1024, 3
#: Characters compressed at a time: short enough that the dictionary matters throughout.
PIECE = 400
#: Bytes that a dictionary is trained on, at most; beyond, samples of 1,000 bytes are taken evenly from all the text.
TRAINING_BYTES = 32_000_000


@dataclass
class QualityModel:
    """Dictionaries by label and the weights of the calibration; None stands for no dictionary."""

    bad: bytes | None
    good: bytes | None
    weights: np.ndarray


def _dictionary(texts: list[str]) -> bytes | None:
    cut = [b[i : i + 1000] for t in texts for b in [t.encode()] for i in range(0, len(b), 1000)]
    most = TRAINING_BYTES // 1000
    if len(cut) > most:
        cut = [cut[i * len(cut) // most] for i in range(most)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, cut).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b" ".join(cut)[:DICTIONARY_BYTES] or None


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if held is not None:
        held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


def sizes(texts: list[str | None], model: QualityModel) -> np.ndarray:
    """Compressed bytes under the bad and the good dictionary, and plain bytes, of each whole text."""
    bad, good = _compressor(model.bad).compress, _compressor(model.good).compress
    out = np.empty((len(texts), 3))
    for k, text in enumerate(texts):
        text = text or ""
        a = b = n = 0
        for i in range(0, max(1, len(text)), PIECE):
            piece = text[i : i + PIECE].encode()
            a += len(bad(piece))
            b += len(good(piece))
            n += len(piece)
        out[k] = a, b, n
    return out


def design(size: np.ndarray) -> np.ndarray:
    """Calibration inputs: normalised differences of bad and good size, alone and scaled by length, and of plain and good size."""
    bad, good, n = size.T
    told, saved = (bad - good) / (bad + good), (n - good) / (n + good)
    return np.stack([np.ones(len(n)), told, told * np.minimum(np.log1p(n), 8), saved, saved * saved], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression; the prior's log-odds if only one label is there.

    Newton steps on standardised inputs, each halved until the penalised likelihood rises.
    """
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        if len(y):
            w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return w
    mean, spread = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    z = np.concatenate((x[:, :1], (x[:, 1:] - mean) / spread), axis=1)
    ridge = np.diag([1e-6, *[0.1] * (len(w) - 1)])

    def loss(w: np.ndarray) -> float:
        t = z @ w
        return float(np.logaddexp(0, t).sum() - y @ t + w @ ridge @ w / 2)

    at = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * np.maximum(p * (1 - p), 1e-9)) @ z + ridge, z.T @ (y - p) - ridge @ w)
        while (now := loss(w + step)) > at and np.abs(step).max() > 1e-10:
            step = step / 2
        if at - now < 1e-9 * (1 + abs(at)):
            break
        w, at = w + step, now
    out = np.concatenate((w[:1], w[1:] / spread))
    out[0] -= (w[1:] * mean / spread).sum()
    return out


def fit(docs: DataFrame, labels: DataFrame, keep: Column, *, text_col: str = "text", per_label: int = PER_LABEL) -> QualityModel:
    """Model from at most per_label rows of each label, chosen by hash order among the labels rows that `keep` allows.

    Two thirds of the documents, without the lines that stand under both labels, make the
    dictionaries, one third the calibration. Dictionaries are trained in tasks; only they and three sizes for each calibration row reach the driver.
    """
    chosen = F.broadcast(label_sample(labels, "quality", per_label, (0, 1), keep))
    texts = docs.select(F.col("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null").join(chosen, "doc_id")
    # at most per_label rows of each label: read from the whole table once
    texts = written(texts.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))), "labelled")

    # lines that stand under both labels tell nothing, and a dictionary that holds one would decide short texts
    lines = texts.filter("part > 0").select("doc_id", "label", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    both = lines.filter("trim(line) <> ''").groupBy("line").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("line")
    told = lines.join(both, "line", "left_anti").groupBy("label", "doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "line")))["line"], "\n").alias("text"))

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"])
        return pd.DataFrame({"label": frame["label"].iloc[:1], "dictionary": [_dictionary(list(frame["text"]))]})

    made = {r.label: r.dictionary and bytes(r.dictionary) for r in told.groupBy("label").applyInPandas(train, "label int, dictionary binary").collect()}
    model = QualityModel(made.get(0), made.get(1), np.zeros(5))

    def measure(rows: pa.StructArray) -> list[pa.Array]:
        return [pa.array(sizes(pc.struct_field(rows, ["text"]).to_pylist(), model).tolist(), pa.list_(pa.float64()))]

    rows = mapped(texts.filter("part = 0"), measure, "sizes array<double>", ["label"]).select("row.label", "sizes").collect()
    model.weights = _logistic(design(np.array([r.sizes for r in rows]).reshape(-1, 3)), np.array([r.label for r in rows], dtype=float))
    return model


def scored(docs: DataFrame, model: QualityModel, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (struct row) with score, the calibrated probability of label 1 for the whole text.

    Null counts as empty; an empty text gets the score of no evidence. Scores depend on the text alone.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.StructArray) -> list[pa.Array]:
        size = sizes(pc.struct_field(rows, [text_col]).cast(pa.string()).to_pylist(), held.value)
        return [pa.array(1 / (1 + np.exp(-np.clip(design(size) @ held.value.weights, -30, 30))), pa.float64())]

    return mapped(docs, run, "score double", list(docs.columns) if carry is None else carry)
