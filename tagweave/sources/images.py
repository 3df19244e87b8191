"""Image files as rows."""

from __future__ import annotations

import json
import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions.tags import encode_base64


def has_extension(path: Column, extensions: list[str], any_case: bool = True) -> Column:
    pattern = r"\.(" + "|".join(extensions) + r")$"
    return (F.lower(path) if any_case else path).rlike(pattern)


def extension_glob(extensions: list[str], any_case: bool = True) -> str:
    def both(c: str) -> str:
        return f"[{c.lower()}{c.upper()}]" if any_case and c.isalpha() else c

    return "*.{" + ",".join("".join(map(both, e)) for e in extensions) + "}"


def scan_images(
    spark: SparkSession, path: str, extensions: list[str] = fixed.IMAGE_EXTENSIONS, any_case: bool = True
) -> DataFrame:
    """Files of a folder as ``(filename, path, length, content)``, filtered by extension.

    The filter is a glob, applied when files are listed, so other files are never read; a class
    of both cases per letter makes it blind to case.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", extension_glob(extensions, any_case)).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("filename"), "path", "length", "content")


def build_requests(
    images: DataFrame, candidates: list[str] | None = fixed.DEFAULT_TAG_CANDIDATES
) -> DataFrame:
    """Requests from ``(filename, content)``: one-line base64 and the same candidates on each row."""
    listed = None if candidates is None else json.dumps(candidates, ensure_ascii=False)
    return images.select(
        "filename",
        encode_base64(F.col("content")).alias("image_base64"),
        F.lit(listed).cast("string").alias("tag_candidates_json"),
    )


def first_n_images(images: DataFrame, n: int) -> DataFrame:
    return images.orderBy("filename").limit(n)


def placeholder(side: int = fixed.PLACEHOLDER_SIDE, channels: int = fixed.PLACEHOLDER_CHANNELS) -> bytes:
    """A black PNG image, which any decoder reads; about 1 KB."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    colour = {1: 0, 3: 2, 4: 6}[channels]
    header = struct.pack(">IIBBBBB", side, side, 8, colour, 0, 0, 0)
    pixels = zlib.compress(bytes((side * channels + 1) * side), 9)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", pixels) + chunk(b"IEND", b"")


def load_with_placeholder(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """Pairs with ``content`` by path and ``load_ok``.

    A pair whose file is missing, empty or null keeps its row with null content; the encoder
    takes the placeholder for it, so those bytes are not shuffled or stored with every such row.
    """
    found = files.select(F.col("path").alias("image_path"), F.when(F.octet_length("content") > 0, F.col("content")).alias("content"))
    joined = pairs.join(found, "image_path", "left")
    return joined.select(*pairs.columns, "content", F.col("content").isNotNull().alias("load_ok"))
