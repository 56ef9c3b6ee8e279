"""Quality by compression: zstandard dictionaries of good and of bad text.

A text that one dictionary compresses better resembles the texts that dictionary was built from. Its evidence are
differences of compressed sizes, normalised by its own size and by what it shrinks to without a dictionary, beside these
two sizes' ratio and its length; a logistic fit, quadratic as short texts bend the boundary, on labelled texts outside
the dictionaries calibrates it. The difference alone finds about three quarters of what this finds among bad texts. A
text is compressed in blocks, each on its own: else a long one would teach the compressor itself, and the dictionaries
would no longer matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm import common

#: Labelled rows of the bad and of the good class that are used, at most: a documented bound on what reaches the driver.
MOST = (2500, 2500)
DICTIONARY_BYTES = 64 * 1024
#: Texts are compressed in blocks of so many bytes, each on its own.
BLOCK = 4096
LEVEL = 1
THRESHOLD = 0.3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray | None = None

    def __post_init__(self) -> None:
        self._compress = None

    def __getstate__(self) -> tuple:
        return self.good, self.bad, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.good, self.bad, self.weights = state
        self._compress = None

    def compressors(self) -> list:
        if self._compress is None:
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            found = [zstandard.ZstdCompressor(**options)]
            for words in (self.good, self.bad):
                data = zstandard.ZstdCompressionDict(words)
                data.precompute_compress(level=LEVEL)
                found.append(zstandard.ZstdCompressor(dict_data=data, **options))
            self._compress = [c.compress for c in found]
        return self._compress

    def evidence(self, text: str) -> tuple[float, ...]:
        raw = text.encode("utf-8", "replace")
        n = len(raw)
        if not n:
            return 0.0, 0.0, 0.0, 0.0, 0.0
        plain, good, bad = (sum(len(compress(b)) for b in blocks(raw)) / n for compress in self.compressors())
        return good - bad, (good - bad) / plain, good, plain, float(np.log1p(n))

    def score(self, texts: list[str]) -> np.ndarray:
        return common.logistic_apply(self.weights, _squared(np.array([self.evidence(t) for t in texts]).reshape(-1, 5)))


def _squared(x: np.ndarray) -> np.ndarray:
    """The evidence, its squares and products with the first."""
    x = x * np.array([10, 10, 5, 5, 0.3])
    return np.column_stack([x, x**2, x[:, :1] * x[:, 2:], x[:, 2:3] * x[:, 3:4]])


def blocks(raw: bytes) -> list[bytes]:
    """All of raw in pieces of BLOCK bytes; a short rest joins the piece before it."""
    found = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    if len(found) > 1 and len(found[-1]) < BLOCK // 4:
        found[-2:] = [found[-2] + found[-1]]
    return found


def _dictionary(texts: list[str]) -> bytes:
    """A dictionary trained on every block; of too few blocks to train on, the blocks themselves."""
    samples = [b for t in texts for b in blocks(t.encode("utf-8", "replace"))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples) or b"\n"


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """Half of the labelled texts build the dictionaries, the rest calibrate; without both classes in both there is no
    model."""
    y = np.array(labels)
    for_words = np.arange(len(y)) % 2 == 0
    if len({*y[for_words]}) < 2 or len({*y[~for_words]}) < 2:
        return None
    chosen = [[t for t, v, c in zip(texts, y, for_words, strict=True) if c and v == k] for k in (1, 0)]
    model = Model(_dictionary(chosen[0]), _dictionary(chosen[1]))
    x = np.array([model.evidence(t) for t, c in zip(texts, for_words, strict=True) if not c])
    model.weights = common.logistic_fit(_squared(x), y[~for_words])
    return model


def fitted(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST) -> Model | None:
    """A model of at most most[class] labelled texts of each class, those with the smallest hash of their id."""
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    # A row that has both labels has none.
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("also")).where("label = also").drop("also")
    return fit(*common.labelled_texts(documents, common.least_by_hash(chosen, most)))


def score(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST, threshold: float = THRESHOLD) -> DataFrame:
    """documents with score (0 to 1, higher: likelier good) and predicted (1 from the threshold on).

    labels holds doc_id and quality of the rows to learn from; at most most[class] of each class are used. Null and
    empty texts get the score of no evidence. Rows with a null label or id are ignored, a row that is labelled both 0
    and 1 has no label, repeated labels count once. Ties of the hash that chooses the sample go by doc_id. With no model
    to fit (a class is missing, no documents) every score is 0. An empty table gives no rows. Columns of documents named
    score or predicted are replaced; others pass through.
    """
    model = fitted(documents, labels, most)
    kept = documents.drop("score", "predicted")

    def each(batch: pa.RecordBatch, model: Model | None) -> list[pa.Array]:
        texts = common.texts_of(batch)
        s = model.score(texts) if model else np.zeros(len(texts))
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

    return common.with_columns(kept, "score double, predicted int", each, model)
