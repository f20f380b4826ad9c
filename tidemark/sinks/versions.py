"""Tables that change by whole versions.

Every write goes to a data folder of its own. A version is a small manifest that lists the folders of each dataset; it
becomes current by one rename, so a reader sees the version before or the version after, and a failed or lost run leaves
nothing but an unlisted folder. Several datasets can change in one version. A change may carry the name of its batch: a
batch that is already part of the table is not applied again.

The rename must not replace a file that is there (true of HDFS and local disks); of two writers one then finds its number
taken, and applies its change to the version of the other.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: How often a change is applied anew because another writer was first.
ATTEMPTS = 20


class Change(NamedTuple):
    """``append`` adds the rows of ``df`` to a dataset, ``overwrite`` puts them in place of all others."""

    df: DataFrame
    mode: str = "append"


class Versions:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        place = self._place(self.path)
        self._files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.getUri(), spark._jsc.hadoopConfiguration()
        )

    def _place(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def numbers(self) -> list[int]:
        """Numbers of all published versions, in order."""
        folder = self._place(self.path, "versions")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self, number: int | None = None) -> dict:
        """The content of a version, the current one if no number is given."""
        if number is None:
            published = self.numbers()
            if not published:
                return {"datasets": {}, "schemas": {}, "batches": []}
            number = published[-1]
        stream = self._files.open(self._place(self.path, "versions", f"{number:020}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str = "rows", number: int | None = None) -> DataFrame | None:
        """A dataset as of a version; None if there is none."""
        manifest = self.manifest(number)
        if name not in manifest["datasets"]:
            return None
        schema = StructType.fromJson(manifest["schemas"][name])
        folders = [f"{self.path}/data/{folder}" for folder in manifest["datasets"][name]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def has(self, batch: str) -> bool:
        return batch in self.manifest()["batches"]

    def publish(self, changes: dict[str, Change], batch: str | None = None) -> bool:
        """Applies all changes as one version; False if ``batch`` is part of the table already.

        The data are written first. What they are derived from may be the table itself.
        """
        if batch is not None and self.has(batch):
            return False
        written = {}
        for name, change in changes.items():
            if change.mode not in ("append", "overwrite"):
                raise ValueError(f"a dataset is appended to or overwritten, not {change.mode}")
            written[name] = uuid.uuid4().hex
            change.df.write.parquet(f"{self.path}/data/{written[name]}")
        for _ in range(ATTEMPTS):
            published = self.numbers()
            now = self.manifest(published[-1]) if published else self.manifest()
            if batch is not None and batch in now["batches"]:
                return False
            for name, change in changes.items():
                schema = StructType(list(change.df.schema)).jsonValue()
                earlier = now["datasets"].get(name, []) if change.mode == "append" else []
                if earlier and _shape(now["schemas"][name]) != _shape(schema):
                    raise ValueError(f"the columns of {name} differ from those of the table")
                now["datasets"][name] = [*earlier, written[name]]
                now["schemas"][name] = now["schemas"][name] if earlier else schema
            if batch is not None:
                now["batches"].append(batch)
            if self._put(now, published[-1] + 1 if published else 0):
                return True
        raise RuntimeError(f"other writers were first {ATTEMPTS} times at {self.path}")

    def _put(self, manifest: dict, number: int) -> bool:
        """Publishes a version; False if its number is taken."""
        draft = self._place(self.path, "versions", f".{uuid.uuid4().hex}.json")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        kept = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        nothing = self._jvm.java.lang.reflect.Array.newInstance(kept, 0)
        try:
            self._context.rename(draft, self._place(self.path, "versions", f"{number:020}.json"), nothing)
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def compact(self, name: str, files: int) -> None:
        """Rewrites a dataset into one folder of about ``files`` files; its rows stay the same."""
        rows = self.read(name)
        if rows is not None:
            self._replace(name, rows.repartition(files))

    def _replace(self, name: str, rows: DataFrame) -> None:
        before = self.manifest()["datasets"][name]
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{folder}")
        for _ in range(ATTEMPTS):
            published = self.numbers()
            now = self.manifest(published[-1])
            listed = now["datasets"][name]
            if listed[: len(before)] != before:
                raise RuntimeError(f"{name} was overwritten meanwhile")
            # what was appended meanwhile stays behind it
            now["datasets"][name] = [folder, *listed[len(before) :]]
            if self._put(now, published[-1] + 1):
                return
        raise RuntimeError(f"other writers were first {ATTEMPTS} times at {self.path}")

    def expire(self, keep: int = 10) -> int:
        """Deletes all versions but the last ``keep``, and the folders that no version lists; returns their number.

        Not to be run beside a writer, whose folder is not listed yet.
        """
        published = self.numbers()
        for number in published[:-keep]:
            self._files.delete(self._place(self.path, "versions", f"{number:020}.json"), False)
        listed = {f for n in published[-keep:] for folders in self.manifest(n)["datasets"].values() for f in folders}
        data = self._place(self.path, "data")
        there = [s.getPath() for s in self._files.listStatus(data)] if self._files.exists(data) else []
        gone = [p for p in there if p.getName() not in listed]
        for path in gone:
            self._files.delete(path, True)
        return len(gone)


def _shape(schema: dict) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in StructType.fromJson(schema)]
