"""Files on the storage Spark itself uses, reached through its Hadoop configuration."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target


def literal_path(path: str) -> str:
    """Escape the characters that Spark readers would expand as glob patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


class SharedFiles:
    """Existence tests and renames; file contents never pass through the driver.

    Needs a session with a JVM of its own. For other sessions override ``qualify``, ``exists``,
    ``make_dir`` and ``move``; everything else is built on these four.
    """

    def __init__(self, spark: SparkSession, threads: int = 32):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        # One pool for all calls: every new Python thread costs a thread in the JVM as well.
        self._pool = ThreadPoolExecutor(threads)
        self._systems: dict[str, Any] = {}

    def _system(self, path: str):
        """File system of a path, looked up once per directory."""
        directory = path.rpartition("/")[0]
        if directory not in self._systems:
            self._systems[directory] = self._path(path).getFileSystem(self._conf)
        return self._systems[directory]

    def qualify(self, path: str) -> str:
        """Absolute form with scheme, without a trailing slash, as Spark's listings show it."""
        return self._system(path).makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def make_dir(self, path: str) -> None:
        self._system(path).mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        """Remove a file or a whole directory; nothing happens if it is not there."""
        self._system(path).delete(self._path(path), True)

    def names(self, path: str) -> list[str]:
        """Names directly in a directory, folders included; none if it is not there."""
        system, directory = self._system(path), self._path(path)
        if not system.exists(directory):
            return []
        return [status.getPath().getName() for status in system.listStatus(directory)]

    def same_system(self, first: str, second: str) -> bool:
        """Whether two paths are on one file system, so that a file can be renamed between them."""
        left, right = (self._path(self.qualify(path)).toUri() for path in (first, second))
        return (left.getScheme(), left.getAuthority()) == (right.getScheme(), right.getAuthority())

    def move(self, src: str, dest: str) -> None:
        if not self._system(src).rename(self._path(src), self._path(dest)):
            raise OSError(f"could not move {src} to {dest}")

    def move_all(self, *batches: list[tuple[str, str]]) -> None:
        """Move batches of files one after the other, the files of a batch at once; all or none.

        Destinations are tested before the first move. If a move fails, the files already moved
        are put back, so that a plain rerun finds the landing directory as it was.
        """
        moves = [move for batch in batches for move in batch]
        taken = [dest for (_, dest), found in self._each(self._dest_exists, moves) if found]
        if taken:
            raise FileExistsError(f"{len(taken)} destinations exist already, first: {taken[0]}")
        moved: list[tuple[str, str]] = []
        for batch in batches:
            outcomes = self._each(self._try_move, batch)
            moved += [move for move, error in outcomes if error is None]
            errors = [error for _, error in outcomes if error is not None]
            if errors:
                back = self._each(self._try_move, [(dest, src) for src, dest in moved])
                stuck = sum(error is not None for _, error in back)
                note = f"; {stuck} moved files could not be put back" if stuck else ""
                raise OSError(f"{len(errors)} of {len(moves)} moves failed{note}: {errors[0]}") from errors[0]

    def _dest_exists(self, move: tuple[str, str]) -> bool:
        return self.exists(move[1])

    def _try_move(self, move: tuple[str, str]) -> Exception | None:
        try:
            self.move(*move)
        except Exception as error:  # noqa: BLE001 - py4j wraps every file system error
            return error
        return None

    def _each(self, action, moves):
        return list(zip(moves, self._pool.map(action, moves), strict=True))


def run_each(spark: SparkSession, action, items: list, parallelism: int) -> list:
    """Apply ``action`` to every item from up to ``parallelism`` driver threads, results in order.

    The threads only submit Spark jobs. ``action`` must handle its own errors.
    """
    if parallelism <= 1 or len(items) <= 1:
        return [action(item) for item in items]
    with ThreadPoolExecutor(min(parallelism, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(action), items))
