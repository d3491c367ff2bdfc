"""Listing file trees."""

import itertools
import os
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import clean_path, file_name, report_type
from ..functions.predicates import has_extension
from ..schemas import INVENTORY
from ..session import written


class EmptyListing(FileNotFoundError):
    """No file with a wanted extension was found."""


WALKED = ("filepath string, size long, mtime timestamp, ctime timestamp, dev long, ino long, nlink long, is_dir boolean, error string, "
          "raw binary")
#: Entries of a folder that are held at once.
PART = 10_000


def text_of(raw: bytes) -> str:
    """A path as text; bytes that are not UTF-8 are written ``%XX``."""
    return "".join(f"%{ord(c) - 0xDC00:02X}" if "\udc80" <= c <= "\udcff" else c for c in raw.decode("utf-8", "surrogateescape"))


def _entries(folder, excluded):
    """A row for every file and folder in a folder, which is read entry by entry; one with the error if it cannot be read."""
    try:
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.name in excluded and entry.is_dir(follow_symlinks=False):
                    continue
                try:
                    stat = entry.stat()
                    yield (text_of(entry.path), stat.st_size, stat.st_mtime_ns // 1000, stat.st_ctime_ns // 1000, stat.st_dev,
                           stat.st_ino, stat.st_nlink, entry.is_dir(follow_symlinks=False), None, entry.path)
                except OSError as error:  # it went meanwhile, or is a link to nowhere
                    yield text_of(entry.path), None, None, None, None, None, None, False, error.strerror or "unreadable", entry.path
    except OSError as error:
        yield text_of(folder), None, None, None, None, None, None, True, error.strerror or "unreadable", folder


def _visit(excluded, part):
    kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.timestamp("us", "UTC"), pa.int64(), pa.int64(),
             pa.int64(), pa.bool_(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in WALKED.split(", ")]

    def visit(batches):
        for batch in batches:
            rows = (row for folder in batch.column(0).to_pylist() for row in _entries(folder, excluded))
            while some := list(itertools.islice(rows, part)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)

    return visit


def walk(spark: SparkSession, roots, exclude_dirs=(), part: int = PART) -> DataFrame:
    """Everything below folders of a mount that all executors have: files, folders, and what could not be read.

    One job for each level of the tree lists its folders in parallel; nothing of the tree is held by the driver, and of a
    folder ``part`` entries at most by its task. Names may be any bytes: ``raw`` has them, ``filepath`` as text. Folders
    named as one of ``exclude_dirs`` below the roots are neither listed nor opened. An unreadable folder is a row with its
    ``error`` and does not stop the others.
    """
    folders = spark.createDataFrame([(bytearray(os.fsencode(r.rstrip("/") or "/")),) for r in roots], "raw binary")
    visit = _visit(frozenset(os.fsencode(d) for d in exclude_dirs), part)
    levels = []
    while True:
        # Spread anew, since a few folders may hold most of the next level.
        found = written(folders.repartition(spark.sparkContext.defaultParallelism).mapInArrow(visit, WALKED), "listing")
        levels.append(found)
        folders = found.filter("is_dir and error is null").select("raw")
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def scan_listing(spark: SparkSession, roots, extensions=(), exclude_dirs=(), empty_ok: bool = False) -> DataFrame:
    """Files under the roots by extension, without those in excluded folders below them; contents are never read.

    Rows are (filepath, size, mtime). Roots are folders of a mount, walked by executors. For an object store, where
    listing a tree of this size is a service of its own, take an inventory: ``read_inventory``.
    """
    listed = walk(spark, roots, exclude_dirs).filter("not is_dir and error is null").select(
        clean_path(F.col("filepath")).alias("filepath"), "size", "mtime")
    if extensions:
        listed = listed.filter(has_extension(F.col("filepath"), extensions))
    if not empty_ok and listed.isEmpty():
        raise EmptyListing(f"no {', '.join(extensions) or 'files'} under {', '.join(roots)}")
    return listed


def unreadable(spark: SparkSession, roots) -> DataFrame:
    """Folders and files under the roots that could not be read, with the error."""
    return walk(spark, roots).filter("error is not null").select("filepath", "error")


def scan_reports(spark: SparkSession, roots) -> DataFrame:
    """Report files (filepath, report_type) under the roots."""
    listed = walk(spark, roots).filter("not is_dir and error is null").select(clean_path(F.col("filepath")).alias("filepath"))
    return listed.withColumn("report_type", report_type(file_name(F.col("filepath")))).filter("report_type is not null")


def read_inventory(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """A stat-level inventory snapshot; device, inode and link count come only this way."""
    return spark.read.schema(INVENTORY).options(**options).format(format).load(path)
