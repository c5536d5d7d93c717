"""Replacing a folder as one step that readers see.

A load is built in a hidden folder beside its target and moved into place by renames when all of
it is written. Until then the old content stands, whatever happens to the load. The old folder is
moved aside first, as no file system renames over a folder that holds files; a driver that dies
between the two renames leaves a finished folder, which ``repair`` moves into place.

A rename is one step on HDFS and local disks. An object store copies file by file behind it: there
a reader may still see part of a folder while it is moved.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Folder of loads under way; its name hides it from Spark's readers.
HIDDEN = "_publish"
NEW, OLD = "new", "old"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


@contextmanager
def publishing(spark: SparkSession, target: str) -> Iterator[str]:
    """Gives the folder to build in; it takes the place of ``target`` when the block ends.

    If the block fails, the target is as before and what was built is deleted.
    """
    repair(spark, target)
    fs, place = _file_system(spark, target)
    work = _work(spark, place).suffix(f"/{place.getName()}.{uuid.uuid4().hex}")
    building, ready = work.suffix("/building"), work.suffix(f"/{NEW}")
    try:
        yield building.toString()
    except BaseException:
        fs.delete(work, True)
        raise
    # from here on the load is finished: whoever finds it may put it in place
    _move(fs, building, ready)
    _put_in_place(fs, work, place)


def _work(spark: SparkSession, place):
    return spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), HIDDEN)


def _put_in_place(fs, work, place) -> None:
    if fs.exists(place):
        _move(fs, place, work.suffix(f"/{OLD}"))
    _move(fs, work.suffix(f"/{NEW}"), place)
    fs.delete(work, True)


def repair(spark: SparkSession, target: str) -> bool:
    """Finish the load of ``target`` whose driver died between the renames; True if there was one.

    Loads that died earlier are left alone: one that is still being built belongs to another driver.
    """
    fs, place = _file_system(spark, target)
    root = _work(spark, place)
    if fs.exists(place) or not fs.exists(root):
        return False
    for work in [s.getPath() for s in fs.listStatus(root)]:
        if work.getName().rsplit(".", 1)[0] == place.getName() and fs.exists(work.suffix(f"/{NEW}")):
            _put_in_place(fs, work, place)
            return True
    return False


def repair_table(spark: SparkSession, root: str) -> int:
    """``repair`` for a whole table: itself and each of its partitions; returns how many there were."""
    done = int(repair(spark, root))
    fs, hidden = _file_system(spark, f"{root}/{HIDDEN}")
    if not fs.exists(hidden):
        return done
    names = {s.getPath().getName().rsplit(".", 1)[0] for s in fs.listStatus(hidden)}
    # a path made of the parts keeps the escapes in a partition's name
    return done + sum(repair(spark, f"{root}/{name}") for name in names)
