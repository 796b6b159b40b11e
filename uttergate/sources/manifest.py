"""Publication of whole runs: every run writes a folder of its own, and numbered manifests say which one counts.

A manifest is written aside and renamed to the next free number, which file systems do in one step and refuse if the
name is taken. So readers see either the old run or the new one, never a mixture, a run that dies publishes nothing,
and of two that end together each gets a number. Manifests are a few hundred bytes; no data goes through the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_published"
ATTEMPTS = 100


class _Files:
    """The session's own file system, seen from the driver."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def system(self, name: str):
        return self.path(name).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        system = self.system(folder)
        if not system.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in system.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.system(name).open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system(name).create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Rename unless the target exists; False if it does."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system(target).getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(self.path(source), self.path(target), options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True


def _numbers(files: _Files, output_dir: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(f"{output_dir}/{FOLDER}") if n.removesuffix(".json").isdigit())


def _manifest(output_dir: str, number: int) -> str:
    return f"{output_dir}/{FOLDER}/{number:020d}.json"


def publish(spark: SparkSession, output_dir: str, run: str, tables: list[str]) -> dict[str, str]:
    """Make the tables of folder ``run`` the current ones of ``output_dir``; returns their paths."""
    files = _Files(spark)
    aside = f"{output_dir}/{FOLDER}/.{uuid.uuid4().hex}.aside"
    files.write(aside, json.dumps({"run": run, "tables": tables}))
    for _ in range(ATTEMPTS):
        taken = _numbers(files, output_dir)
        if files.rename_new(aside, _manifest(output_dir, taken[-1] + 1 if taken else 1)):
            return {t: f"{output_dir}/{run}/{t}" for t in tables}
    raise RuntimeError(f"no free manifest number in {output_dir} after {ATTEMPTS} attempts")


def published(spark: SparkSession, output_dir: str) -> dict[str, str]:
    """The paths of the last published run's tables; none if there was no run."""
    files = _Files(spark)
    numbers = _numbers(files, output_dir)
    if not numbers:
        return {}
    last = json.loads(files.read(_manifest(output_dir, numbers[-1])))
    return {t: f"{output_dir}/{last['run']}/{t}" for t in last["tables"]}
