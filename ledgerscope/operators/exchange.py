"""Messages between tasks that run at the same time, as files of a folder that all of them see.

Spark's own exchange between the tasks of a barrier stage takes a second, which is too long for
work that meets a thousand times. Here a message is a file, written under another name and then
renamed, so that a reader finds it whole or not at all; readers look for it until it is there.
Spark ends all tasks of a barrier stage when one fails, so no reader waits for a lost task.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession


def slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time now; 0 if a barrier stage is not possible."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    sc = spark.sparkContext._jsc.sc()
    return int(sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path by which Python opens ``path``; None if only Spark's file systems reach it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


class Exchange:
    """The mail of task ``rank`` of a barrier stage, in a folder of this attempt of the stage."""

    def __init__(self, folder: str, ctx: BarrierTaskContext):
        self.rank = ctx.partitionId()
        # the attempt's name comes from the first task; so does the news whether all see the folder
        said = ctx.allGather(f"{uuid.uuid4().hex} {int(os.path.isdir(folder))}")
        self.size, self.shared = len(said), all(s.endswith(" 1") for s in said)
        self.folder = f"{folder}/{said[0].split()[0]}"
        if self.shared:
            os.makedirs(self.folder, exist_ok=True)

    def _file(self, name: str, rank: int) -> str:
        return f"{self.folder}/{name}-{rank}"

    def put(self, name: str, data: bytes) -> None:
        to = self._file(name, self.rank)
        with open(f"{to}-new", "wb") as f:
            f.write(data)
        os.replace(f"{to}-new", to)

    def get(self, name: str, rank: int, start: int = 0, length: int = -1) -> bytes:
        wait = 0.0002
        while True:
            try:
                with open(self._file(name, rank), "rb", buffering=0) as f:
                    f.seek(start)
                    return f.read(length)
            except FileNotFoundError:
                time.sleep(wait)
                wait = min(wait * 1.2, 0.01)

    def drop(self, name: str) -> None:
        """Remove the own message that all others have read."""
        os.remove(self._file(name, self.rank))
