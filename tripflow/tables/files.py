"""The few file system calls that have no DataFrame form, through Spark's own Hadoop client."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import SparkSession

MOVERS = 16
#: Moves handed to the movers at once.
BATCH = 1024


class Files:
    """The file system that holds `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """Names directly below `folder`; none if it does not exist."""
        if not self.exists(folder):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(folder))]

    def walk(self, folder: str) -> Iterator[str]:
        """Paths of all files below `folder`, as the file system lists them."""
        if self.exists(folder):
            found = self._fs.listFiles(self._path(folder), True)
            while found.hasNext():
                yield found.next().getPath().toString()

    def age_and_size(self, path: str) -> tuple[int, int]:
        """The newest change of a file below `path` (of `path` itself if there is none), in
        milliseconds since 1970, and the bytes of all of them."""
        newest, size = 0, 0
        found = self._fs.listFiles(self._path(path), True)
        while found.hasNext():
            status = found.next()
            newest, size = max(newest, status.getModificationTime()), size + status.getLen()
        return newest or self._fs.getFileStatus(self._path(path)).getModificationTime(), size

    def date_back(self, path: str, days: int) -> None:
        """Make a file look `days` older."""
        changed = self._fs.getFileStatus(self._path(path)).getModificationTime()
        self._fs.setTimes(self._path(path), changed - days * 86_400_000, -1)

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def mark(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename; a move that already happened is left alone."""
        if not self.exists(source):
            if self.exists(target):
                return
            raise FileNotFoundError(source)
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def move_all(self, moves: Iterable[tuple[str, str]]) -> int:
        """Moves side by side, taken from `moves` a batch at a time."""
        waiting, done = iter(moves), 0
        with ThreadPoolExecutor(MOVERS) as pool:
            while batch := list(islice(waiting, BATCH)):
                done += sum(1 for _ in pool.map(lambda move: self.move(*move), batch))
        return done
