"""Dead-letter files: append lines, read them back for another try."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.operators.delivery import dead_letter_lines, decode_split, parse_dead_letters


def append_dead_letters(failed: DataFrame, path: str) -> None:
    """Append one line per failed record to the text files below `path`."""
    dead_letter_lines(failed).write.mode("append").text(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return parse_dead_letters(spark.read.text(path))


def replay_dead_letters(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events decoded from dead-letter lines, and the lines whose value cannot be decoded."""
    letters = read_dead_letters(spark, path).withColumnRenamed("error", "delivery_error")
    return decode_split(letters)
