"""Path guards and Parquet reads with fallback.

Existence is asked of the Hadoop FileSystem of the path, so the same code
works on local disk, HDFS and object stores.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when the folder holds at least one non-hidden, non-empty file (recursively)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")) and st.getLen() > 0:
            return True
    return False


def has_rows(df: DataFrame) -> bool:
    """A one-row probe; an empty file or a filtered-out slice both count as no data."""
    return not df.isEmpty()


class MissingInput(FileNotFoundError):
    """None of the candidate paths exists."""


def read_first(spark: SparkSession, paths: Sequence[str],
               reader: Callable[[str], DataFrame]) -> tuple[str, DataFrame]:
    """Read the first path that holds data files (e.g. increment folder, else full-load folder).

    An empty folder does not shadow a later one; if no path has data the first existing one
    is read (no rows).
    """
    existing = [path for path in paths if path_exists(spark, path)]
    for path in existing:
        if has_data_files(spark, path):
            return path, reader(path)
    if existing:
        return existing[0], reader(existing[0])
    raise MissingInput(f"none of {list(paths)} exists")


def read_parquet_or_none(spark: SparkSession, path: str,
                         schema: T.StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None when the folder is absent or has no data files."""
    if not has_data_files(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below ``path``, sorted; none when it is absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f"{path.rstrip('/')}/{st.getPath().getName()}" for st in fs.listStatus(p) if st.isDirectory())


def largest_key(spark: SparkSession, path: str, key: str, ending: str = "") -> int:
    """The largest N of the names ``key=N<ending>`` below ``path``; 0 when there is none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return 0
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    found = [n[len(key) + 1:len(n) - len(ending)] for n in names if n.startswith(f"{key}=") and n.endswith(ending)]
    return max(map(int, found), default=0)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def modified_at(spark: SparkSession, path: str) -> float:
    """When a folder last changed, in seconds from now (negative: ago)."""
    fs, p = _fs_path(spark, path)
    return (fs.getFileStatus(p).getModificationTime() - spark.sparkContext._jvm.System.currentTimeMillis()) / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_if_absent(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a file unless ``target`` exists; False if it does."""
    sc = spark.sparkContext
    fs_package = sc._jvm.org.apache.hadoop.fs
    (_, source), (_, goal) = _fs_path(spark, path), _fs_path(spark, target)
    context = fs_package.FileContext.getFileContext(goal.toUri(), sc._jsc.hadoopConfiguration())
    rename = getattr(fs_package, "Options$Rename")
    options = sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(context.makeQualified(source), context.makeQualified(goal), options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder (recursively) through its Hadoop FileSystem; False if absent."""
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False
