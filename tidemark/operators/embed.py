"""Embeddings: a provider protocol, and a provider that needs no network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.batches import by_known
from tidemark.operators.calls import in_groups

BATCH = 512
_WORD = re.compile(r"\w+")


class Provider(Protocol):
    model_name: str

    @property
    def dimensions(self) -> int: ...

    def embed_documents(self, texts: list[str]) -> np.ndarray: ...


class HashingProvider:
    """Signed feature hashing of words, of unit length; the same text has the same vector everywhere."""

    def __init__(self, model_name: str = "hashing-small", dimensions: int | None = None):
        self.model_name, self._n = model_name, dimensions

    @property
    def dimensions(self) -> int:
        return self._n or (1536 if "small" in self.model_name else 3072)

    def embed_documents(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for i, t in enumerate(texts):
            h = np.fromiter((zlib.crc32(m[0].encode()) for m in _WORD.finditer(t.lower())), np.int64)
            np.add.at(out[i], h % self.dimensions, np.where(h >> 31 & 1, 1, -1))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embed(chunks: DataFrame, provider: Provider, text: str = "text", batch: int = BATCH, concurrency: int = 1, rate: float | None = None) -> DataFrame:
    """Chunks with ``embedding``, in calls of at most ``batch`` texts, ``concurrency`` of them at once, order kept; null texts have null. A call that fails is made again text by text; a text that fails then fails the job."""

    @F.arrow_udf("array<float>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # with one call at a time a step is a call; else there is enough in a step to keep all calls busy
        for part in (x for p in parts for x in by_known(p, batch if concurrency <= 1 else 4 * batch * concurrency)):
            texts, out = part.to_pylist(), [None] * len(part)
            known = [i for i, t in enumerate(texts) if t is not None]
            for i, (v, error) in zip(known, in_groups([texts[i] for i in known], provider.embed_documents, batch, concurrency, rate), strict=True):
                if error:
                    raise error
                out[i] = v
            yield pa.array(out, pa.list_(pa.float32()))

    return chunks.withColumn("embedding", run(F.col(text)))
