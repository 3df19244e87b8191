"""Caption sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.numbers import int_div

CAPTION_SCHEMA = (
    "annotations array<struct<image_id: bigint, caption: string>>, "
    "images array<struct<id: bigint, file_name: string>>"
)


def scan_captions(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Caption objects (two arrays each) as ``(annotations, images)`` rows.

    One object that fills a file is read whole by one task, so a large source should be many
    files or, with ``multi_line=False``, one object per line, which Spark can split.
    """
    objects = spark.read.schema(CAPTION_SCHEMA).option("multiLine", multi_line).json(path)
    annotations = objects.select(F.explode("annotations").alias("a")).select("a.image_id", "a.caption")
    images = objects.select(F.explode("images").alias("i")).select("i.id", "i.file_name")
    return annotations, images


def write_caption_objects(captions: DataFrame, path: str, run: int = 64) -> None:
    """Write captions as JSON lines, an object per range of image ids.

    Captions go in by runs of caption numbers as well, so an object has at most ``run * run``
    captions even if one image has most of them.
    """
    piece = F.struct(
        int_div("image_id", run).alias("ids"),
        int_div("cap_no", run).alias("run"),
    )
    objects = captions.groupBy(piece.alias("piece")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("image_id", "cap_no", "caption"))),
            lambda a: F.struct(a["image_id"].alias("image_id"), a["caption"].alias("caption")),
        ).alias("annotations"),
        F.transform(
            F.array_sort(F.collect_set("image_id")),
            lambda i: F.struct(
                i.alias("id"), F.concat(F.lit("IMG_"), i.cast("string"), F.lit(".jpg")).alias("file_name")
            ),
        ).alias("images"),
    )
    objects.select(F.to_json(F.struct("annotations", "images"))).write.text(path)
