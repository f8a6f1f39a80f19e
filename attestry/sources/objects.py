"""Object listings and object contents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.schemas import OBJECT_INVENTORY

# Contents are handed back in batches of about this many bytes.
BATCH_BYTES = 32 * 1024 * 1024
# Bytes of one piece of a file.
PIECE_BYTES = 8 * 1024 * 1024


def object_name(path: Column | str, root: str) -> Column:
    """Name of an object below ``root`` (a full URI prefix)."""
    path = F.col(path) if isinstance(path, str) else path
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 2**31 - 1)).otherwise(
        path
    )


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """A stored inventory table ``(name, size)``, e.g. a daily listing export."""
    return spark.read.schema(OBJECT_INVENTORY).parquet(path)


def list_objects(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """List objects below a URI. Only path and length are read, never the content.

    Meant for small containers: Spark lists files through the driver, and its
    file sources leave out empty files. Use an inventory export for the rest.
    """
    uri = _full_uri(root)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(object_name("path", uri).alias("name"), F.col("length").alias("size"))
    )
    return listed.where(F.col("name").startswith(prefix)) if prefix else listed


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """All objects below a URI with their content: ``(name, size, content)``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(
            object_name("path", _full_uri(root)).alias("name"),
            F.col("length").alias("size"),
            "content",
        )
    )


def _full_uri(root: str) -> str:
    return root if ":/" in root else f"file:{root}"


def _with_scheme(root: str) -> str:
    """A path without a scheme would be another folder on every worker."""
    if ":/" not in root:
        raise ValueError(f"{root} names no store; write it with a scheme")
    return root.rstrip("/")


def fetch_contents(manifest: DataFrame, root: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Manifest rows with ``found`` and ``content``, each file read by the task that holds its row.

    Nothing but the manifest is shuffled, and only the files it names are read.
    Use ``read_objects`` with a join instead when most of a container is wanted, and
    ``fetch_pieces`` for files that should not be one value. ``root`` needs a scheme.
    """
    columns = manifest.schema
    output = (
        T.StructType(list(columns.fields))
        .add("found", T.BooleanType())
        .add("content", T.BinaryType())
    )
    base = _with_scheme(root)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, start = fs.FileSystem.from_uri(base)

        def packed(batch, begin, found, contents):
            part = batch.slice(begin, len(found))
            arrays = [*part.columns, pa.array(found, pa.bool_()), pa.array(contents, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "found", "content"])

        for batch in batches:
            begin, held, found, contents = 0, 0, [], []
            for path in batch.column("blob_path").to_pylist():
                try:
                    with store.open_input_file(f"{start}/{path}") as source:
                        contents.append(source.readall())
                    found.append(True)
                    held += len(contents[-1])
                except FileNotFoundError:
                    contents.append(None)
                    found.append(False)
                if held >= batch_bytes:
                    yield packed(batch, begin, found, contents)
                    begin, held, found, contents = begin + len(found), 0, [], []
            if found:
                yield packed(batch, begin, found, contents)

    return manifest.mapInArrow(fetch, output)



def plan_pieces(
    sizes: DataFrame, name: str = "blob_path", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """(name, piece_no, offset, length): byte ranges of files, from ``(name, size_bytes)``.

    An empty file has one empty piece, a file without a size none.
    """
    count = F.greatest(F.ceil(F.col("size_bytes") / piece_bytes), F.lit(1))
    numbered = sizes.where(F.col("size_bytes").isNotNull()).select(
        name, "size_bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("piece_no")
    )
    offset = F.col("piece_no") * piece_bytes
    length = F.least(F.col("size_bytes") - offset, F.lit(piece_bytes).cast("bigint"))
    return numbered.select(name, "piece_no", offset.alias("offset"), length.alias("length"))


def cut_pieces(
    contents: DataFrame, name: str = "blob_path", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """(name, piece_no, content): contents ``(name, content)`` in pieces of equal size."""
    size = F.octet_length("content").cast("bigint")
    count = F.greatest(F.ceil(size / piece_bytes), F.lit(1))
    number = F.sequence(F.lit(0).cast("bigint"), count - 1)
    cut = contents.where(F.col("content").isNotNull()).select(
        name, "content", F.explode(number).alias("piece_no")
    )
    start = (F.col("piece_no") * piece_bytes + 1).cast("int")
    return cut.select(
        name, "piece_no", F.substring(F.col("content"), start, F.lit(piece_bytes)).alias("content")
    )


def fetch_pieces(
    manifest: DataFrame, root: str, piece_bytes: int = PIECE_BYTES, partitions: int | None = None
) -> DataFrame:
    """(blob_path, piece_no, content) of the files of a manifest (blob_path, size_bytes).

    Each piece is read by its byte range, in the task that holds its row, so the
    pieces of a large file are read side by side and no value holds a whole file.
    A missing file has one piece with null content; bytes beyond ``size_bytes`` are
    not read.
    """
    base = _with_scheme(root)
    ranges = plan_pieces(manifest.select("blob_path", "size_bytes").distinct(), piece_bytes=piece_bytes)
    ranges = ranges.repartition(partitions) if partitions else ranges.repartition("blob_path", "piece_no")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, start = fs.FileSystem.from_uri(base)
        names = ["blob_path", "piece_no", "content"]
        for batch in batches:
            for path, number, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    with store.open_input_file(f"{start}/{path}") as source:
                        content = source.read_at(length, offset)
                except FileNotFoundError:
                    if number:
                        continue
                    content = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([number], pa.int64()), pa.array([content], pa.binary())],
                    names,
                )

    return ranges.mapInArrow(fetch, "blob_path string, piece_no bigint, content binary")


def piece_summary(pieces: DataFrame, name: str = "blob_path") -> DataFrame:
    """(name, found, num_pieces, size, digest) from pieces ``(name, piece_no, content)``.

    The digest is the SHA-256 of the hexadecimal SHA-256 digests of the pieces in order, so
    only digests come together. A file whose only piece has no content was not found.
    """
    own = pieces.select(
        name,
        "piece_no",
        F.octet_length("content").cast("bigint").alias("_size"),
        F.sha2("content", 256).alias("_digest"),
    )
    return (
        own.groupBy(name)
        .agg(
            F.sum("_size").alias("size"),
            F.count("_size").alias("num_pieces"),
            F.expr("listagg(_digest, '') within group (order by piece_no)").alias("_all"),
        )
        .select(
            name,
            (F.col("num_pieces") > 0).alias("found"),
            "num_pieces",
            "size",
            F.sha2(F.col("_all").cast("binary"), 256).alias("digest"),
        )
    )
