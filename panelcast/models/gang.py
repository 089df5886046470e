"""Tasks that run side by side and add up arrays, by files in the folder that all executors share.

A barrier stage starts all of its tasks at once, but its own exchange waits a whole second each time. Here every task writes what
it has under the number of the exchange and reads what the others wrote; what an exchange left is deleted by its writer two
exchanges later, when all must have read it. Only the agreement on a folder goes through the stage, so that a stage that is run
again starts with an empty one.
"""

from __future__ import annotations

import os
import shutil
import time
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark import BarrierTaskContext, SparkContext
from pyspark.sql import SparkSession

from panelcast.staging import scratch_path

#: Bytes that a task reads whole from all others; of more it adds up its own part, and reads the sums of the other parts.
WHOLE = 1 << 23


def slots(context: SparkContext) -> int:
    """Tasks that can run at the same time; 0 where a barrier stage can't be had."""
    if context.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    scala = context._jsc.sc()
    most = scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())
    return min(context.defaultParallelism, most)


def shared_folder(spark: SparkSession) -> str | None:
    """A new path in the shared folder as workers see it; None where it is no mounted one."""
    path = urlparse(scratch_path(spark, "gang"))
    return unquote(path.path) if path.scheme in ("", "file") else None


def remove(folder: str) -> None:
    shutil.rmtree(folder, ignore_errors=True)


class Gang:
    """A task's place among all tasks of its stage."""

    def __init__(self, folder: str, rank: int, size: int):
        self.folder, self.rank, self.size, self.number = folder, rank, size, 0
        os.makedirs(folder, exist_ok=True)

    @classmethod
    def of_stage(cls, folder: str) -> Gang:
        context = BarrierTaskContext.get()
        names = context.allGather(uuid.uuid4().hex)
        return cls(os.path.join(folder, names[0]), context.partitionId(), len(names))

    def _path(self, rank: int, number: int) -> str:
        return os.path.join(self.folder, f"{number}-{rank}")

    def put(self, data) -> None:
        """Begin an exchange: what the others get to read."""
        self.number += 1
        own = self._path(self.rank, self.number)
        with open(f"{own}.part", "wb") as f:
            f.write(data)
        os.rename(f"{own}.part", own)
        if self.number > 2:
            os.remove(self._path(self.rank, self.number - 2))

    def get(self, rank: int, begin: int = 0, length: int = -1) -> bytes:
        """What a task has put, as soon as it has."""
        path, pause = self._path(rank, self.number), 0.0002
        while True:
            try:
                with open(path, "rb") as f:
                    f.seek(begin)
                    return f.read(length)
            except FileNotFoundError:
                time.sleep(pause)
                pause = min(2 * pause, 0.02)

    def total(self, own: np.ndarray) -> np.ndarray:
        """The sum of the arrays of all tasks."""
        if self.size == 1:
            return own
        flat = np.ascontiguousarray(own).ravel()
        kind, width = flat.dtype, flat.dtype.itemsize
        self.put(flat.data)
        if flat.nbytes * self.size <= WHOLE:
            return self._add(flat, 0, len(flat)).reshape(own.shape)
        limits = [len(flat) * i // self.size for i in range(self.size + 1)]
        part = self._add(flat, limits[self.rank], limits[self.rank + 1])
        self.put(part.data)
        parts = [np.frombuffer(self.get(i, 0, (limits[i + 1] - limits[i]) * width), kind) for i in range(self.size)]
        return np.concatenate(parts).reshape(own.shape)

    def _add(self, flat: np.ndarray, begin: int, end: int) -> np.ndarray:
        width, out = flat.dtype.itemsize, flat[begin:end].copy()
        for rank in range(self.size):
            if rank != self.rank:
                out += np.frombuffer(self.get(rank, begin * width, (end - begin) * width), flat.dtype)
        return out
