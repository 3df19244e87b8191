"""Odd rows that every operator must survive."""

from pyspark.sql import functions as F

LONG = " ".join(f"long{i % 977} tail" for i in range(40_000))


def odd_texts():
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e"), (6, "a b c d e"), (7, LONG), (8, LONG),
        (9, "É Ünï çödé x \U0001f600 don't 12 3.4"), (10, "x" * 5000), (11, "\x00\x01 .,;"),
    ]


def odd_docs(spark, rows=None):
    """Ids and texts of the rows, with clashing and nested extra columns and a null in each."""
    df = spark.createDataFrame(rows if rows is not None else odd_texts(), "doc_id long, text string")
    none = F.lit(None)
    return df.withColumns(
        {"lang": none.cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"), "score": none.cast("int"), "ids": F.lit("clash"), "_id": F.lit(0), "spans": F.struct(F.lit(1).alias("x"))}
    )
