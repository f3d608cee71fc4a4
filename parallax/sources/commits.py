"""Entries of a shared folder that become visible whole, and once.

Data goes to a folder of its own, ``data/of=<entry>-<id>``; an entry exists from the moment its
manifest ``commits/<entry>`` does, which names that folder.  The manifest is written beside and
renamed, and a rename never replaces a manifest: a writer that was interrupted leaves nothing
visible, and of two writers of one entry (a replayed micro-batch, a repeated round) the first
one counts.  Readers take the folders that manifests name, by a join, so they list nothing.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass
class Commits:
    spark: SparkSession
    path: str

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{name}")

    def _files(self):
        return self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def begin(self, entry: str, note: str = "") -> str:
        """A new folder for the data of an entry, seen by no reader yet; a ``note`` stands in its
        name, behind an underscore."""
        if not _NAME.fullmatch(entry) or not re.fullmatch("[a-z0-9]*", note):
            raise ValueError(f"not a name for an entry: {entry!r} {note!r}")
        return f"{self.path.rstrip('/')}/data/of={entry}{'_' if note else ''}{note}-{uuid.uuid4().hex[:12]}"

    def commit(self, entry: str, folder: str) -> bool:
        """Makes the folder the data of the entry; False, and the folder goes, if it has data."""
        jvm, files = self.spark._jvm, self._files()
        of = folder.rpartition("/of=")[2]
        beside, final = self._at(f"pending/{of}"), self._at(f"commits/{entry}")
        out = files.create(beside, True)
        out.write(bytearray(f"{entry} {of}\n".encode()))
        out.close()
        files.mkdirs(self._at("commits"))
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else files.getUri(),
                                                                      self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(beside, final, options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            files.delete(beside, False)
            files.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
            return False

    def has(self, entry: str) -> bool:
        return self._files().exists(self._at(f"commits/{entry}"))

    def entries(self) -> DataFrame:
        """(entry, of): what is committed."""
        if not self._files().exists(self._at("commits")):
            return self.spark.createDataFrame([], "entry string, of string")
        words = F.split("value", " ")
        return self.spark.read.text(f"{self.path.rstrip('/')}/commits").select(words[0].alias("entry"), words[1].alias("of"))

    def folder(self, entry: str) -> str:
        found = [r.of for r in self.entries().filter(F.col("entry") == entry).collect()]
        if not found:
            raise FileNotFoundError(f"{self.path} has no entry {entry}")
        return f"{self.path.rstrip('/')}/data/of={found[0]}"


LOG_SCHEMA = "job string, step long, n long, loss double, secs double"


class ProgressLog:
    """One row for each training round or micro-batch, appended once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.commits = spark, Commits(spark, path)

    def append(self, job: str, step: int, n: int, loss: float | None, secs: float | None = None) -> bool:
        """False if the step of the job is there already (a replay)."""
        entry = f"{job}-{step:012d}"
        if self.commits.has(entry):
            return False
        folder = self.commits.begin(entry)
        self.spark.createDataFrame([(job, step, n, loss, secs)], LOG_SCHEMA).coalesce(1).write.parquet(folder)
        return self.commits.commit(entry, folder)

    def read(self) -> DataFrame:
        entries = self.commits.entries()
        if entries.isEmpty():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        rows = self.spark.read.schema(f"{LOG_SCHEMA}, of string").parquet(f"{self.commits.path.rstrip('/')}/data")
        return rows.join(entries.select("of"), "of", "left_semi").drop("of")


def observed(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    """The frame with metrics that are known once it has been written.  Metrics are summed by
    the tasks of the writing stage, each of which counts once however often it is tried."""
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), seen


def save_version(tables: dict[str, DataFrame], spark: SparkSession, path: str, epoch: int) -> None:
    """All tables of an epoch, visible together; an epoch is saved once."""
    commits = Commits(spark, path)
    entry = f"epoch-{epoch:08d}"
    if commits.has(entry):
        raise FileExistsError(f"{path} has epoch {epoch}")
    folder = commits.begin(entry)
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    if not commits.commit(entry, folder):
        raise FileExistsError(f"{path} has epoch {epoch}")


def epochs(spark: SparkSession, path: str) -> list[int]:
    """The saved epochs in order."""
    names = Commits(spark, path).entries().filter(F.col("entry").startswith("epoch-")).select("entry").collect()
    return sorted(int(r.entry[6:]) for r in names)


def load_version(spark: SparkSession, path: str, names: list[str], epoch: int | None = None) -> tuple[int, dict[str, DataFrame]]:
    """The tables of an epoch, by default of the last one saved."""
    epoch = max(epochs(spark, path), default=-1) if epoch is None else epoch
    folder = Commits(spark, path).folder(f"epoch-{epoch:08d}")
    return epoch, {n: spark.read.parquet(f"{folder}/{n}") for n in names}
