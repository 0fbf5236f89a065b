"""Publishing tables so that readers never meet half of one.

``replacing`` writes a table beside the old one and puts it in its place by two renames when it is whole; a job that fails on the
way leaves the old table as it was. ``publish`` keeps versions of a whole layout of tables: each is written to a folder of its own,
and the file ``CURRENT``, replaced in one step, names the one that readers take. So all tables of a layout change together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CURRENT = "CURRENT"


def files_of(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A path to write to; what is there in the end takes the place of ``path``."""
    files, target = files_of(spark, path)
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    try:
        yield fresh
    except BaseException:
        files.delete(_path(spark, fresh), True)
        raise
    if target.getParent() is not None:
        files.mkdirs(target.getParent())
    there = files.exists(target)
    if there and not files.rename(target, _path(spark, old)):
        raise OSError(f"could not put {path} aside")
    if not files.rename(_path(spark, fresh), target):
        if there:
            files.rename(_path(spark, old), target)
        raise OSError(f"could not put the new table at {path}")
    if there:
        files.delete(_path(spark, old), True)


def current(spark: SparkSession, root: str) -> str:
    """The folder of the version that readers take."""
    files, manifest = files_of(spark, f"{root}/{CURRENT}")
    if not files.exists(manifest):
        raise FileNotFoundError(f"{root} has no published version")
    return f"{root}/{spark.read.text(f'{root}/{CURRENT}', wholetext=True).first()[0].strip()}"


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """Lets ``write`` fill a new version's folder, then makes it the current one; the version before stays until ``drop_old``."""
    name = f"v-{uuid.uuid4().hex}"
    files, folder = files_of(spark, f"{root}/{name}")
    try:
        write(f"{root}/{name}")
    except BaseException:
        files.delete(folder, True)
        raise
    jvm = spark.sparkContext._jvm
    fresh = _path(spark, f"{root}/_{name}")
    out = files.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    # One step: a reader finds the old name or the new one.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(fresh), context.makeQualified(_path(spark, f"{root}/{CURRENT}")), options)
    return f"{root}/{name}"


def drop_old(spark: SparkSession, root: str) -> int:
    """Deletes all versions but the current one; how many."""
    kept = current(spark, root).rsplit("/", 1)[1]
    files, folder = files_of(spark, root)
    old = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("v-") and s.getPath().getName() != kept]
    for path in old:
        files.delete(path, True)
    return len(old)
