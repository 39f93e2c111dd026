"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.session import shared_root

# Fast word-by-word paths hold for texts below this code point: there every character is
# stable under NFC, and case mapping does not depend on context.
SIMPLE_LIMIT = "\u0250"


def tuned(spark: SparkSession) -> SparkSession:
    """Settings for tasks that hand whole texts to Python: few rows at a time, since a text
    can be long, and this package on the workers' path wherever they start."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{shared_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read again: cuts the lineage, and
    a lost executor costs no more than the stage that was running."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def expanded(df: DataFrame, count: str, number: str) -> DataFrame:
    """Every row ``count`` times, numbered from 0 in ``number``; no range that is made for
    it holds more than 65,536 numbers."""
    wide = 1 << 16
    last = F.col(count) - 1
    high = F.sequence(F.lit(0).cast("long"), F.floor(last / wide))
    low = F.sequence(F.lit(0).cast("long"), F.least(F.lit(wide - 1).cast("long"), last - F.col("_high") * wide))
    each = df.withColumn("_high", F.explode(high)).withColumn("_low", F.explode(low))
    return each.withColumn(number, F.col("_high") * wide + F.col("_low")).drop("_high", "_low")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def pieces(rows: list[str], characters: int):
    """Consecutive (start, end) ranges of ``rows`` of about so many characters each."""
    start = held = 0
    for i, text in enumerate(rows):
        held += len(text)
        if held >= characters:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(rows):
        yield start, len(rows)


def text_pieces(column: pa.Array, size: int):
    """(start, end, texts) of consecutive rows of about so many bytes each; only one
    piece at a time becomes Python strings."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, end, texts_of(column.slice(start, end - start))
        start = end


# --- files in the shared folder -----------------------------------------------------------


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path, which the cluster mounts everywhere."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri if "://" not in uri else None


def write_bytes(uri: str, chunks) -> None:
    """Write a file under a name of its own and rename it, so that a repeated or lost
    task attempt never leaves half a file under the final name."""
    own = f"{uri}.{uuid.uuid4().hex}"
    path = local_path(own)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            for chunk in chunks:
                out.write(chunk)
        os.replace(path, local_path(uri))
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(own)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(path, fs.FileSystem.from_uri(uri)[1])


def map_array(uri: str, dtype):
    """A flat file as an array: memory-mapped where the store is mounted, else read."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=dtype)
