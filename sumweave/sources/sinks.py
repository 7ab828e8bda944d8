"""Result sinks."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.sources import blockgzip
from sumweave.sources.regions import write_zones


def write_indexed(df: DataFrame, path: str, by: Sequence[str] = ("chr",), place: str = "pos",
                  ties: Sequence[str] = ()) -> None:
    """A table sorted by position and partitioned by chromosome.

    Range partitioning spreads a large chromosome over many files, each with a narrow range of
    positions. The zone map beside the table, one row per file, lets a region query open only the
    files it needs (:func:`sumweave.sources.regions.scan_regions`): the role of a position index.
    """
    keys = [*by, place, *ties]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").partitionBy(*by).parquet(path))
    write_zones(df.sparkSession, path, by, place)


def write_tsv(df: DataFrame, path: str, precision: int = 5, compression: str = "gzip") -> None:
    """Text form with a header per part file, NA for missing values. Nothing is quoted, names with a # neither."""
    lines, header = text_lines(df, precision)
    with_header(lines, header).write.mode("overwrite").text(path, compression=compression)


def write_bgz(df: DataFrame, path: str, precision: int = 5) -> None:
    """Text form as block-gzip parts, each of which begins with the header."""
    lines, header = text_lines(df, precision)
    blockgzip.write_lines(with_header(lines, header), path)


def write_single(df: DataFrame, path: str, precision: int = 5) -> int:
    """Text form as one block-gzip file under one header, rows in partition order; returns its size.

    All tasks compress their part; the parts are then copied end to end. Parts are kept beside the
    file as ``<path>.parts``.
    """
    lines, header = text_lines(df, precision)
    blockgzip.write_lines(lines, f"{path}.parts", ended=False)
    return blockgzip.join_parts(df.sparkSession, f"{path}.parts", path, header)


def text_lines(df: DataFrame, precision: int = 5) -> tuple[DataFrame, str]:
    """(value) lines of tab-separated text, NA for missing values, and the header."""
    from sumweave.operators.render import render

    text = render(df, precision)
    return text.select(F.concat_ws("\t", *[F.col(f"`{c}`") for c in text.columns]).alias("value")), "\t".join(text.columns)


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """The header before the lines of every partition."""
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    return lines.mapInArrow(run, "value string")


def write_hits(df: DataFrame, path: str, p: str, threshold: float) -> None:
    write_tsv(df.filter(F.col(f"`{p}`") < threshold), path, compression="none")


def write_sites(sites: DataFrame, path: str) -> None:
    """Sites in VCF text form; header lines are a part file of their own, which sorts first."""
    spark = sites.sparkSession
    header = ["##fileformat=VCFv4.0", "#" + "\t".join(sites.columns)]
    (spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path}/header"))
    (sites.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in sites.columns]).alias("value"))
     .write.mode("overwrite").text(f"{path}/body"))
