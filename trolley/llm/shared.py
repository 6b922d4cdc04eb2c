"""What several corpus operators share: folds, work folders, slices of batches.

A null text is an empty text throughout, unless an operator says otherwise.
"""

from __future__ import annotations

import functools
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A slice of a batch holds about so many characters, however long single texts are.
SLICE_CHARS = 4 << 20
#: Names the folder made for a session without spark.checkpoint.dir.
OWN_FOLDER = "trolley.llm.folder"


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame, name: str) -> Column:
    """All columns of ``df`` as one struct, so that none clashes with those of an operator."""
    return F.struct(*map(quoted, df.columns)).alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one made of it that no column of ``df`` has, in upper or lower case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names.

    Only where none is named and Spark runs in one process is a folder made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_FOLDER, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set(OWN_FOLDER, folder)
    return f"{folder.rstrip('/')}/corpus/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, kept if executors go."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Write a small file into the shared folder and return where it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{work_path(spark, 'file')}-{name}")
    with tempfile.NamedTemporaryFile() as file:  # of the driver, until it is copied
        file.write(content)
        file.flush()
        source = spark._jvm.org.apache.hadoop.fs.Path(f"file://{file.name}")
        store = target.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(target.getParent())
        store.copyFromLocalFile(False, True, source, target)
    return target.toString()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors once, as ``--py-files`` would.

    Their Python workers import it, wherever the driver was started.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(shared_file(spark, packed.getvalue(), "package.zip"))
    _shipped.add(application)


def shipped(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage, whose first argument is the session, that ships the package."""

    @functools.wraps(step)
    def run(spark: SparkSession, *arguments) -> DataFrame:
        ship_package(spark)
        return step(spark, *arguments)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(
    frame: pd.DataFrame, column: str = "text", chars: int = SLICE_CHARS
) -> Iterator[pd.DataFrame]:
    """Rows in order, cut so that each slice has about ``chars`` characters at most.

    A single longer text is a slice by itself.
    """
    if not len(frame):
        return
    place = np.cumsum(frame[column].str.len().to_numpy(dtype=np.int64))
    cuts = np.flatnonzero(np.diff((place - 1).clip(0) // chars)) + 1
    edges = [0, *cuts.tolist(), len(frame)]
    for start, stop in zip(edges, edges[1:]):
        yield frame.iloc[start:stop]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700.0, 700.0)))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, by a hash of ``key``; all rows where there are fewer."""
    rows = df.count()
    if rows <= most:
        return df
    share = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000))
    return df.where(share < F.lit(int(1_000_000 * most / rows)))


def text_slices(batch, column: str = "text", size: int = SLICE_CHARS) -> Iterator:
    """An Arrow batch cut into batches whose texts have about ``size`` bytes at most.

    A single longer text is a batch by itself.
    """
    if not batch.num_rows:
        return
    column_of = batch.column(column)
    kind = np.int64 if column_of.type in ("large_string", "large_binary") else np.int32
    ends = np.frombuffer(column_of.buffers()[1], kind)
    place = ends[column_of.offset : column_of.offset + batch.num_rows + 1].astype(np.int64)
    place = place[1:] - place[0]
    cuts = np.flatnonzero(np.diff((place - 1).clip(0) // size)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for start, stop in zip(edges, edges[1:]):
        yield batch.slice(start, stop - start)
