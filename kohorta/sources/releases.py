"""Several written folders that appear together.

Everything is written beside its place first. Then one small file, the manifest,
says which folders are to be moved where; from the moment it is there the release
counts, and whoever finds it (the writer, or the next run after a crash) finishes
the moves. Before that moment all targets are as they were.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession


class Files:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def system(self, name: str):
        return self.path(name).getFileSystem(self.conf)

    def exists(self, name: str) -> bool:
        return self.system(name).exists(self.path(name))

    def delete(self, name: str) -> None:
        self.system(name).delete(self.path(name), True)

    def move(self, source: str, target: str) -> None:
        if not self.system(source).rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def write(self, name: str, text: str) -> None:
        out = self.system(name).create(self.path(name), True)
        out.write(text.encode("utf-8"))
        out.close()

    def read(self, name: str) -> str:
        source = self.system(name).open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode("utf-8")
        finally:
            source.close()


def split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ".", name


class Release:
    """A set of target folders, always released in full."""

    def __init__(self, spark: SparkSession, targets: Sequence[str]):
        self.files, self.targets, self.run = Files(spark), list(targets), uuid.uuid4().hex
        mark = hashlib.sha256("\n".join(self.targets).encode()).hexdigest()[:16]
        self.manifest = f"{split(self.targets[0])[0]}/_release-{mark}.json"

    def staged(self, target: str) -> str:
        """Where a target is written; readers of the parent folder pass over the name."""
        parent, name = split(target)
        return f"{parent}/_staged-{self.run}-{name}"

    def publish(self) -> None:
        """Makes the staged folders the targets; from the manifest on nothing goes back."""
        moves = [(self.staged(t), t) for t in self.targets]
        draft = f"{self.manifest}-{self.run}"
        self.files.write(draft, json.dumps(moves))
        self.files.move(draft, self.manifest)
        self.finish()

    def finish(self) -> None:
        """Moves what a manifest that is there says; moves already made are passed over."""
        if not self.files.exists(self.manifest):
            return
        for source, target in json.loads(self.files.read(self.manifest)):
            if self.files.exists(source):
                if self.files.exists(target):
                    self.files.delete(target)
                self.files.move(source, target)
        self.files.delete(self.manifest)

    def withdraw(self) -> None:
        """Deletes what was staged and not published."""
        for target in self.targets:
            if self.files.exists(self.staged(target)):
                self.files.delete(self.staged(target))
