"""End-to-end batch jobs over delimited table folders.

Folder layout (one folder per table, text in the ``extract`` or ``sample``
dialect): ``<folder>/<table>/part-*``.

* ``run_full``: all six tables from the full-load folder -> marts, replacing
  what the store held (the store registers every year it loads, so a following
  increment cannot add a year twice).
* ``run_increment``: facts from the increment folder (required: a missing
  folder raises ``MissingInput``; a folder without data files returns
  ``NO_NEW_DATA``); every dimension and the bridge from the increment folder
  when present, else from the full-load folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STAR_TABLES
from ..sources import delimited, files
from ..star import Star, star_from_frames
from .incremental import LoadResult, MartStore

FACT = "fact_passenger_entry_exit"
NO_NEW_DATA = "NO_NEW_DATA"


def _reader(spark: SparkSession, table: str, dialect: str, schemas=None):
    schema = (schemas or {}).get(table, STAR_TABLES[table])
    return lambda path: delimited.read_delimited(spark, path, schema, dialect)


def star_from_folder(spark: SparkSession, folder: str, dialect: str = "extract",
                     schemas: dict | None = None) -> Star:
    """The six tables from ``folder``; ``schemas`` overrides the declared schema per table."""
    folder = folder.rstrip("/")
    return star_from_frames({t: _reader(spark, t, dialect, schemas)(f"{folder}/{t}")
                             for t in STAR_TABLES})


def run_full(spark: SparkSession, folder: str, store_root: str, dialect: str = "extract",
             schemas: dict | None = None) -> LoadResult:
    store = MartStore(spark, store_root)
    star = star_from_folder(spark, folder, dialect, schemas)
    return store.replace(star)


def run_increment(spark: SparkSession, inc_folder: str, full_folder: str, store_root: str,
                  dialect: str = "extract", reload: bool = False,
                  schemas: dict | None = None) -> LoadResult | str:
    inc_folder, full_folder = inc_folder.rstrip("/"), full_folder.rstrip("/")
    fact_path = f"{inc_folder}/{FACT}"
    if not files.path_exists(spark, fact_path):
        raise files.MissingInput(f"increment facts not found at {fact_path}")
    if not files.has_data_files(spark, fact_path):
        return NO_NEW_DATA
    frames: dict[str, DataFrame] = {FACT: _reader(spark, FACT, dialect, schemas)(fact_path)}
    for table in STAR_TABLES:
        if table == FACT:
            continue
        _, frames[table] = files.read_first(
            spark, [f"{inc_folder}/{table}", f"{full_folder}/{table}"],
            _reader(spark, table, dialect, schemas))
    return MartStore(spark, store_root).load(star_from_frames(frames), reload=reload)
