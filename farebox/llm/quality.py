"""Quality by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A text is cut
into windows, and each is compressed with either dictionary; whichever kind it resembles
saves more. The difference of the summed sizes, over the text's bytes, becomes a score by
a logistic curve fitted on other labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import hashed_sample, labelled_sample, text_bytes

MOST_TRAINING = 6000  # labelled documents that dictionaries and curve are made from
MOST_WINDOWS = 4000  # of each label for a dictionary
WINDOW = 2048  # bytes
DICTIONARY = 1 << 16
LEVEL = 3
THRESHOLD = 0.3


def windows(data: bytes) -> Iterator[bytes]:
    """The whole text in pieces of ``WINDOW`` bytes, the last one shorter."""
    for at in range(0, len(data), WINDOW):
        yield data[at : at + WINDOW]


@dataclass
class CompressionClassifier:
    good: bytes
    bad: bytes
    slope: float = 0.0
    offset: float = 0.0

    def __getstate__(self) -> dict:
        return {name: self.__dict__[name] for name in ("good", "bad", "slope", "offset")}

    @cached_property
    def _compressors(self) -> tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]:
        made = []
        for content in (self.good, self.bad):
            dictionary = zstd.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstd.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
        return made[0], made[1]

    def difference(self, text: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, per byte; 0 for no text."""
        good, bad = self._compressors
        saved = sum(len(bad.compress(w)) - len(good.compress(w)) for w in windows(text))
        return saved / max(len(text), 1)

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * differences + self.offset)))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    try:
        return zstd.train_dictionary(DICTIONARY, samples, k=256, d=8, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def curve(differences: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, lightly shrunk, by Newton's method."""
    scale = max(float(np.std(differences)), 1e-6)
    x = np.column_stack([differences / scale, np.ones(len(differences))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - labels) + np.array([0.1, 0.01]) * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.1, 0.01])
        w -= np.linalg.solve(curvature, gradient)
    return float(w[0] / scale), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, held_out: Column, most: int = MOST_TRAINING
) -> CompressionClassifier:
    """Learn from labelled documents not held out: two thirds for the dictionaries, the rest
    for the curve. Where a label is missing the score is the same everywhere: 1, if only good
    documents are known or none at all, else 0."""
    sample = labelled_sample(docs, labels, "quality", held_out, most).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3))
    )
    cut = F.arrow_udf("array<binary>")(_cut_texts)
    pieces = sample.where("part < 2").select("label", F.explode(cut("text")).alias("piece"))
    kinds = []
    for label in (1, 0):
        # A passage repeated in many documents counts once.
        chosen = hashed_sample(pieces.where(F.col("label") == label).select("piece"), MOST_WINDOWS)
        kinds.append(sorted(bytes(row.piece) for row in chosen.collect()))
    # As many windows of each kind: a dictionary made from more would suit any text better.
    fewest = min(map(len, kinds))
    good, bad = (kind[:fewest] for kind in kinds)
    if not fewest:
        return CompressionClassifier(b"", b"", 0.0, -50.0 if kinds[1] else 50.0)
    model = CompressionClassifier(dictionary(good), dictionary(bad))
    measured = sample.where("part = 2").select("label", _difference("text", model, docs).alias("x")).toArrow()
    x, y = measured["x"].to_numpy(), measured["label"].to_numpy().astype(float)
    model.slope, model.offset = curve(x, y) if len(x) else (1.0, 0.0)
    return model


def _cut_texts(texts: pa.Array) -> pa.Array:
    data, offsets = text_bytes(texts)
    return pa.array(
        [list(windows(data[a:b].tobytes())) for a, b in zip(offsets, offsets[1:], strict=False)],
        pa.list_(pa.binary()),
    )


def _difference(text: str, model: CompressionClassifier, docs: DataFrame) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def measured(texts: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        found = [sent.value.difference(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
        return pa.array(found, pa.float64())

    return measured(F.col(text))


def quality(text: str, model: CompressionClassifier, docs: DataFrame) -> Column:
    """Column of scores from 0 to 1, higher for good, for the whole text in column ``text``
    of ``docs``. A NULL or empty text gets the curve's value at no difference."""
    x = _difference(text, model, docs) if model.good and model.bad else F.lit(0.0)
    return 1 / (1 + F.exp(-(F.lit(model.slope) * x + F.lit(model.offset))))
