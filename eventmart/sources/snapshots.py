"""Versioned folders that readers never see half written.

A write goes to a folder of its own; it counts only when the log names it.  The log, ``<root>/_log``, has one small file a
commit, numbered, renamed into place as a whole and never over another: of two commits at once one tries again with the next number.
An entry says which version each name has now and which it had before; every ``FULL_EVERY`` entries one has the state of
all names, so a reader lists the log and reads the last of those and what follows.

A run that dies before its commit leaves the earlier version as it was; one that dies in its commit, either.  The version before the last is kept
for readers that have begun with it, older ones are deleted.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

FULL_EVERY = 64
#: Column of the versions among a lake's folders.
VERSION_COLUMN = "_snapshot"


class Snapshots:
    """The current version of each name under ``root``; ``pattern`` gives a name's folder."""

    def __init__(self, spark: SparkSession, root: str, pattern: str = "{name}"):
        self.spark, self.root, self.pattern = spark, root.rstrip("/"), pattern
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._log = f"{self.root}/_log"
        self._known: dict[int, dict] = {}

    # -- log --------------------------------------------------------------------------------------------
    def _numbers(self) -> list[int]:
        at = self._path(self._log)
        if not self._fs.exists(at):
            return []
        return sorted(int(n.split(".")[0]) for n in (s.getPath().getName() for s in self._fs.listStatus(at)) if n[0].isdigit())

    def _entry(self, number: int) -> dict:
        if number not in self._known:                       # an entry never changes
            stream = self._fs.open(self._path(f"{self._log}/{number:020d}.json"))
            try:
                self._known[number] = json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        return self._known[number]

    def _state(self) -> tuple[int, dict[str, list[str]]]:
        """Number of the last entry; of each name the current version and the one before."""
        numbers, state = self._numbers(), {}
        first = max((n for n in numbers if n % FULL_EVERY == 0), default=0)
        for n in numbers:
            if n >= first:
                state.update(self._entry(n))
        return (numbers[-1] if numbers else 0), state

    def versions(self) -> dict[str, str]:
        """The current version of every name."""
        return {name: v[0] for name, v in self._state()[1].items()}

    # -- folders ----------------------------------------------------------------------------------------
    def folder(self, name: str, version: str) -> str:
        return f"{self.root}/{self.pattern.format(name=name)}/{VERSION_COLUMN}={version}"

    def current(self, name: str) -> str | None:
        """Folder of the current version."""
        version = self.versions().get(name)
        return None if version is None else self.folder(name, version)

    def begin(self) -> str:
        """A version that no other write has."""
        return f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"

    def commit(self, name: str, version: str) -> None:
        """From now on readers see this version of the name."""
        while True:
            last, state = self._state()
            before = state.get(name, [])
            change, number = {name: [version, *before[:1]]}, last + 1
            entry = {**state, **change} if number % FULL_EVERY == 0 else change
            if self._put(number, json.dumps(entry)):
                break
        for old in before[1:]:
            self._fs.delete(self._path(self.folder(name, old)), True)

    def _put(self, number: int, text: str) -> bool:
        """Write an entry, unless there is one of that number."""
        self._fs.mkdirs(self._path(self._log))
        draft, final = self._path(f"{self._log}/_draft-{uuid.uuid4().hex}"), self._path(f"{self._log}/{number:020d}.json")
        out = self._fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.exists(final) and self._fs.rename(draft, final):
            return True
        self._fs.delete(draft, False)
        return False

    def abandon(self, name: str, version: str) -> None:
        """Delete a version that was never committed."""
        self._fs.delete(self._path(self.folder(name, version)), True)
