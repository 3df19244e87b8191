"""Encoders: a hashed word vector for text, and a slot for any model over bytes."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.arrow import plain, unit_rows

TEXT_DIMS = 64
WORD_BREAK = "[ \t\n\r]+"
# Bytes that the stand-in model counts at a time, each of which takes about 30 bytes of memory there.
PIECE_BYTES = 1 << 18

# Takes a binary Arrow array, returns an (n, d) matrix.
Encoder = Callable[[pa.Array], np.ndarray]


def encode_texts(texts: DataFrame, id_col: str, text_col: str, dims: int = TEXT_DIMS) -> DataFrame:
    """Unit-length hashed word counts in sparse form: ``(id, bucket, weight)``.

    Words are hashed by md5 into ``dims`` buckets. All words of all texts count.
    """
    words = texts.select(F.col(id_col), F.explode(F.split(text_col, WORD_BREAK)).alias("word")).where("word <> ''")
    bucket = F.pmod(F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long"), F.lit(dims)).cast("int")
    counts = words.groupBy(id_col, bucket.alias("bucket")).agg(F.count("*").cast("double").alias("n"))
    # A text has at most ``dims`` buckets, so its list is short.
    lists = counts.groupBy(id_col).agg(
        F.collect_list(F.struct("bucket", "n")).alias("cells"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm")
    )
    cells = lists.select(id_col, "norm", F.inline("cells"))
    return cells.select(id_col, "bucket", (F.col("n") / F.col("norm")).alias("weight"))


def dense_vectors(sparse: DataFrame, id_col: str, dims: int = TEXT_DIMS) -> DataFrame:
    """Sparse rows as one vector per id: ``(id, emb)``."""
    lists = sparse.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "weight"))).alias("m"))
    full = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0)))
    return lists.select(id_col, full.alias("emb"))


def image_encoder(load: Callable[[], Encoder], placeholder: bytes | None = None):
    """Arrow UDF from image bytes to unit vectors.

    Null or empty bytes give null, or the vector of ``placeholder`` if that is given, so that a
    placeholder travels once and not with every row that lacks an image.

    ``load`` builds the model inside the worker, once per task and before its first batch, so
    the model itself is never pickled. The mark at the end keeps Spark from copying the call.
    """

    @F.arrow_udf("array<double>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for content in batches:
            vectors = encode_content(model, content, placeholder)
            yield pa.array([None if v is None else v.tolist() for v in vectors], pa.list_(pa.float64()))

    return encode.asNondeterministic()


def encode_content(model: Encoder, content: pa.Array, placeholder: bytes | None = None) -> list[np.ndarray | None]:
    """Unit vector of each image; None, or that of the placeholder, where the bytes are null or empty."""
    content = plain(content).cast(pa.large_binary())
    good = pc.fill_null(pc.greater(pc.binary_length(content), 0), False)
    if placeholder is not None:
        content = pc.if_else(good, content, pa.scalar(placeholder, pa.large_binary()))
        good = pa.array([True] * len(content))
    kept = content if pc.all(good).as_py() else content.filter(good)
    vectors = iter(unit_rows(model(kept)) if len(kept) else ())
    return [next(vectors) if ok else None for ok in good.to_pylist()]


def strict_base64(text: str | None) -> bytes | None:
    """Decoded bytes, or None for text that is null or no valid base64."""
    try:
        return None if text is None else base64.b64decode(text, validate=True)
    except ValueError:
        return None


def encode_images(
    images: DataFrame, id_col: str, content: str, load: Callable[[], Encoder], placeholder: bytes | None = None
) -> DataFrame:
    """Run a model over image bytes: ``(id, emb)``."""
    return images.select(id_col, image_encoder(load, placeholder)(F.col(content)).alias("emb"))


def byte_histogram(dims: int = 64) -> Callable[[], Encoder]:
    """A stand-in model: counts of byte values modulo ``dims``, over the whole content."""

    def load() -> Encoder:
        def encode(content: pa.Array) -> np.ndarray:
            content = content.cast(pa.large_binary())
            offsets = np.frombuffer(content.buffers()[1], dtype=np.int64)
            offsets = offsets[content.offset : content.offset + len(content) + 1]
            data = np.frombuffer(content.buffers()[2] or b"", dtype=np.uint8)
            counts = np.zeros((len(content), dims))
            for start in range(int(offsets[0]), int(offsets[-1]), PIECE_BYTES):
                end = min(start + PIECE_BYTES, int(offsets[-1]))
                # The contents that have bytes in this piece.
                first, last = np.searchsorted(offsets, start, "right") - 1, np.searchsorted(offsets, end, "left")
                row = np.repeat(np.arange(last - first), np.diff(np.clip(offsets[first : last + 1], start, end)))
                found = np.bincount(row * dims + data[start:end] % dims, minlength=(last - first) * dims)
                counts[first:last] += found.reshape(last - first, dims)
            return counts

        return encode

    return load
