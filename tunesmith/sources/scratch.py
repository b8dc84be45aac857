"""Written tables that cut a lineage or hold a layout."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
# Paths given out in this process, in order, names of tables in the catalog, and layouts by what they hold.
_paths: list[str] = []
_tables: list[str] = []
_layouts: dict[tuple, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    # A "local-cluster" has executors of its own, which need not share a folder.
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="tunesmith-")
    return _own_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that operators write inside the block when it ends.

    A result that is read from them must be used inside the block.
    """
    paths, tables, layouts = len(_paths), len(_tables), set(_layouts)
    try:
        yield
    finally:
        for name in _tables[tables:]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in _paths[paths:]:
            files, place = _place(spark, path)
            files.delete(place, True)
        del _paths[paths:], _tables[tables:]
        for key in set(_layouts) - layouts:
            del _layouts[key]


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _is_there(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def drop_later(name: str) -> None:
    """Have ``released`` drop a table of the catalog, whose files are in the scratch folder."""
    _tables.append(name)


def written_once(spark: SparkSession, key: tuple, write: Callable[[str], None]) -> str:
    """The path of the layout that ``write`` makes, made at the first call of the session with this key.

    ``key`` says what the layout holds: its source and how it is laid out. It is for sources
    that do not change while the session lasts. A layout that someone has deleted is made again.
    """
    key = (spark.sparkContext.applicationId, *key)
    if key not in _layouts or not _is_there(spark, _layouts[key]):
        path = new_path(spark, str(key[1]))
        write(path)
        _layouts[key] = path
    return _layouts[key]


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Lost executors then cost no recomputation, and values that may differ
    between two runs of a plan (partition numbers of a sampled range
    partitioning) are fixed. The table stays until the folder is cleaned.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
