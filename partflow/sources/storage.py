"""The few file-system questions a job asks, through Hadoop's FileSystem."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)


#: Directories moved at the same time, and the start of the name of those moved aside
#: (readers leave out names that begin so).
_MOVES_AT_ONCE = 16
_ASIDE = "_replaced-"


# How often and after how many seconds a publication is tried again.
_ATTEMPTS, _FIRST_WAIT, _LONGEST_WAIT = 10, 10, 120


@dataclass(frozen=True)
class Retry:
    """How often something is tried, and the seconds between: each wait is twice the one before, up to a longest."""

    attempts: int = _ATTEMPTS
    first_wait: float = _FIRST_WAIT
    longest_wait: float = _LONGEST_WAIT

    def wait(self, attempt: int) -> float:
        """Seconds to wait after the attempt of this number (from 1)."""
        return min(self.first_wait * 2 ** (attempt - 1), self.longest_wait)


@dataclass(frozen=True)
class Move:
    """A directory to put in another's place; if it has a single file, that gets the name ``file_name``."""

    source: str
    target: str
    file_name: str | None = None


@dataclass(frozen=True)
class Moved:
    """How a move went: the attempts it took, and why the last one failed (None: done)."""

    move: Move
    attempts: int
    error: str | None = None


def _aside(target: str) -> str:
    parent, name = target.rstrip("/").rsplit("/", 1)
    return f"{parent}/{_ASIDE}{name}"


class Storage:
    """File systems as the session is configured to reach them."""

    def __init__(self, spark: SparkSession) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._local = spark._jvm.java.io.File
        self._settings = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, text: str):
        path = self._path(text)
        return path.getFileSystem(self._settings), path

    def qualified(self, text: str) -> str:
        """The path with scheme and authority, spelled as listings spell it."""
        files, path = self._at(text)
        return files.makeQualified(path).toString()

    def exists(self, text: str) -> bool:
        files, path = self._at(text)
        return files.exists(path)

    def is_directory(self, text: str) -> bool:
        files, path = self._at(text)
        return files.exists(path) and files.getFileStatus(path).isDirectory()

    def matching(self, pattern: str) -> list[str]:
        """Paths that match a glob pattern, sorted."""
        files, path = self._at(pattern)
        return sorted(status.getPath().toString() for status in files.globStatus(path) or [])

    def modified(self, pattern: str) -> dict[str, float]:
        """Paths that match a glob pattern, with the seconds since the epoch of their last change."""
        files, path = self._at(pattern)
        return {s.getPath().toString(): s.getModificationTime() / 1000 for s in files.globStatus(path) or []}

    def delete(self, text: str) -> None:
        """Delete a file or directory, if it is there."""
        files, path = self._at(text)
        files.delete(path, True)

    def replace_directories(self, moves: Iterable[Move], retry: Retry | None = None) -> list[Moved]:
        """Move each source to its target, which it replaces; names change, no data is read.

        The old target is moved aside first, brought back if the new one can't be
        put in its place, and deleted last: at no time is it the only copy that is
        deleted. What a crash between the two moves left aside is brought back by
        :meth:`restore`. Moves wait for the file system, so several go on at once; one
        that fails is tried again and, failing still, stops no other.
        """
        with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
            return list(pool.map(lambda move: self._attempt(move, retry or Retry(attempts=1)), list(moves)))

    def _attempt(self, move: Move, retry: Retry) -> Moved:
        error = None
        for attempt in range(1, retry.attempts + 1):
            try:
                self.replace(move)
                return Moved(move, attempt)
            except (OSError, Py4JError) as failure:
                error = f"{type(failure).__name__}: {str(failure)[:300]}"
                logger.warning("attempt %d of %d: %s", attempt, retry.attempts, error)
            if attempt < retry.attempts:
                time.sleep(retry.wait(attempt))
        return Moved(move, retry.attempts, error)

    def replace(self, move: Move) -> None:
        """One attempt at a move."""
        source, target = move.source, move.target
        files, path = self._at(target)
        aside = self._path(_aside(target))
        if move.file_name is not None:
            held = self.matching(f"{source}/*.parquet")
            if len(held) == 1 and held[0].rsplit("/", 1)[1] != move.file_name:
                self.rename(held[0], f"{source}/{move.file_name}")
        if files.exists(path):
            files.delete(aside, True)
            if not files.rename(path, aside):
                raise OSError(f"cannot move {target} aside")
        else:
            files.mkdirs(path.getParent())
        try:
            moved = files.rename(self._path(source), path)
        except Py4JError as error:
            moved = False
            logger.warning("moving %s to %s: %s", source, target, error)
        if not moved:
            if files.exists(aside):
                files.rename(aside, path)
            raise OSError(f"cannot move {source} to {target}")
        files.delete(aside, True)

    def claim(self, folder: str, token: str) -> bool:
        """Whether the folder is the caller's: made now, or before with the same ``token``.

        Of several callers at once one makes the file ``taken`` in it, as the file system
        makes no file twice; the token follows in its name, so a claim broken off between
        the two is nobody's and stays unused.
        """
        files, path = self._at(folder)
        mine = self._path(f"{path.toString()}/by-{token}")
        if files.getScheme() == "file":  # Hadoop looks and makes in two steps there
            files.mkdirs(path)
            taken = self._local(f"{path.toUri().getPath()}/taken").createNewFile()
        else:
            try:
                taken = files.createNewFile(self._path(f"{path.toString()}/taken"))
            except Py4JError as error:  # another one made it since it was looked for
                if "FileAlreadyExists" not in str(error):
                    raise
                taken = False
        if taken:
            files.createNewFile(mine)
        return taken or files.exists(mine)

    def make_directory(self, text: str) -> None:
        files, path = self._at(text)
        files.mkdirs(path)

    def rename(self, source: str, target: str) -> None:
        files, path = self._at(target)
        if not files.rename(self._path(source), path):
            raise OSError(f"cannot rename {source} to {target}")

    def restore(self, parent: str) -> None:
        """Bring back what replacements that were cut short have left aside below ``parent``."""
        for left in self.matching(f"{parent}/{_ASIDE}*"):
            files, aside = self._at(left)
            target = self._path(aside.getParent(), aside.getName()[len(_ASIDE) :])
            if files.exists(target):
                files.delete(aside, True)
            else:
                files.rename(aside, target)


def qualified(spark: SparkSession, path: str) -> str:
    return Storage(spark).qualified(path)


def exists(spark: SparkSession, path: str) -> bool:
    return Storage(spark).exists(path)


def is_directory(spark: SparkSession, path: str) -> bool:
    return Storage(spark).is_directory(path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    return Storage(spark).matching(pattern)
