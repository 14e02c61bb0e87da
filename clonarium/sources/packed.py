"""The bytes of packed files as they lie, in pieces: a file is read by one task, but is never a row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrameReader, SparkSession


def packing(spark: SparkSession, path: str) -> str | None:
    """The ending of a file's name by which a reader of lines would unpack it."""
    hadoop = spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = codecs.getCodec(hadoop.fs.Path(path))
    return codec.getDefaultExtension() if codec is not None else None


def reader_as_it_lies(spark: SparkSession, ending: str) -> DataFrameReader:
    """A reader of lines, cut at line feeds, that does not unpack files of this ending."""
    codec = spark._jvm.org.apache.hadoop.io.compress.PassthroughCodec
    options = {"io.compression.codecs": codec.CLASSNAME, codec.OPT_EXTENSION: ending}
    return spark.read.options(**options).option("lineSep", "\n")


def whole_bytes(lines: Iterator[bytes], size: int, path: str) -> Iterator[bytes]:
    """The bytes of a file of this size, in pieces, given all its lines without their ends."""
    n_bytes = -1
    for line in lines:
        yield line if n_bytes < 0 else b"\n" + line
        n_bytes += len(line) + 1
    # Whether the last line has an end is told by the size.
    if n_bytes == size - 1:
        yield b"\n"
    elif n_bytes != size:
        raise RuntimeError(f"{path} has {size} bytes, of which {n_bytes} were read")
