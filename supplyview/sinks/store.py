"""A store of runs that readers see whole.

Every run writes into a folder of its own, ``data/<run>``, with the layout of ``write_results``.
What readers follow is the highest numbered file in ``versions``: it names the run of every
date, of the dimension, of the aliases and of the reports. A run becomes visible by one
rename of the next version, which fails if another run has taken that number. Until then, and
after a failure, readers have the version before, with none of the run's files.

Two runs from one version both keep what they found: whoever comes second reads the new
version, appends its new products and aliases to that version's, and tries the next number.
Dates are replaced as wholes; of two runs of one date the later one stands.

The rename is atomic on HDFS and on local disks. On a store where it is not, let one
run at a time publish.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyview.operators import dimension as D
from supplyview.schemas import ALIASES, DIMENSION
from supplyview.sinks.tables import write_aliases, write_dimension, write_results
from supplyview.sources.files import read_aliases, read_dimension

DATED = ("fact", "combined", "pivot", "enhanced_pivot")
MOST_TRIES = 50


@dataclass(frozen=True)
class Version:
    """What one version shows; folders are relative to the store."""

    number: int = 0
    dates: Mapping[str, str] = field(default_factory=dict)
    dimension: str | None = None
    aliases: str | None = None
    reports: str | None = None


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading -------------------------------------------------------------

    def latest(self) -> Version:
        number = max(self._numbers(), default=0)
        if not number:
            return Version()
        (text,) = self.spark.read.text(self._version_file(number), wholetext=True).first()
        return Version(**json.loads(text))

    def dimension(self, at: Version | None = None) -> DataFrame:
        at = at or self.latest()
        if at.dimension is None:
            return self.spark.createDataFrame([], DIMENSION)
        return read_dimension(self.spark, f"{self.root}/{at.dimension}")

    def aliases(self, at: Version | None = None) -> DataFrame:
        at = at or self.latest()
        if at.aliases is None:
            return self.spark.createDataFrame([], ALIASES)
        return read_aliases(self.spark, f"{self.root}/{at.aliases}")

    def read(self, name: str, dates: Sequence[str] | None = None, at: Version | None = None) -> DataFrame | None:
        """``fact`` or a pivot of all dates, or of ``dates`` (``yyyy-mm-dd``) alone, each from the run
        that the version names; None without any. Only their folders are listed."""
        if name not in DATED:
            raise ValueError(f"name must be one of {DATED}")
        shown = (at or self.latest()).dates
        chosen = [d for d in sorted(shown) if dates is None or d in dates]
        paths = [f"{self.root}/{shown[d]}/{name}/ingest_date={d}" for d in chosen]
        paths = [p for p in paths if self._exists(p)]
        if not paths:
            return None
        reader = self.spark.read
        if name == "fact":
            found = reader.parquet(*paths)
        else:
            # Pivots of different runs may have different statuses.
            parts = [reader.option("header", True).csv(p) for p in paths]
            found = parts[0].withColumn("_path", F.col("_metadata.file_path"))
            for part in parts[1:]:
                found = found.unionByName(
                    part.withColumn("_path", F.col("_metadata.file_path")), allowMissingColumns=True
                )
        path = F.col("_path") if "_path" in found.columns else F.col("_metadata.file_path")
        date = F.to_date(F.regexp_extract(path, r"ingest_date=([0-9-]{10})", 1))
        return found.withColumn("ingest_date", date).drop("_path")

    # --- publishing ----------------------------------------------------------

    def publish(self, results, base: Version | None = None) -> Version:
        """Write a run's results and show them as the next version.

        ``base`` is the version whose dimension and aliases the run has read; the latest one
        by default.
        """
        base = base or self.latest()
        run = f"data/{uuid.uuid4().hex}"
        folder = f"{self.root}/{run}"
        # Dates are read from several runs at once, so they are the only folders.
        write_results(results, folder, "run", fact_by=["ingest_date"])
        days = results.fact.select("ingest_date").distinct().orderBy("ingest_date")
        dates = {str(r["ingest_date"]): run for r in days.collect()}  # one short text per day
        mine = Version(
            base.number, {**base.dates, **dates}, f"{run}/dimension/version=run",
            f"{run}/aliases" if results.aliases is not None else base.aliases,
            f"{run}/reports/version=run",
        )
        for _ in range(MOST_TRIES):
            shown = Version(**{**asdict(mine), "number": mine.number + 1})
            if self._commit(shown):
                return shown
            other = self.latest()
            mine = self._rebased(results, run, other, dates)
        raise RuntimeError(f"{MOST_TRIES} other runs were published meanwhile")

    def _rebased(self, results, run: str, other: Version, dates: Mapping[str, str]) -> Version:
        """This run's results on top of another version: that one's entries come first."""
        known = self.dimension(other)
        added = D.new_products(results.dimension, known)
        with_category = results.dimension.join(added, "product", "left_semi").select("product", "category")
        both = known.select("product", "category", "file_pos").unionByName(
            with_category.withColumn("file_pos", F.lit(None).cast("bigint"))
        )
        dimension = write_dimension(both, f"{self.root}/{run}/dimension", f"on-{other.number}", again=True)
        aliases = other.aliases
        if results.aliases is not None:
            aliases = f"{run}/aliases-on-{other.number}"
            write_aliases(D.upsert_aliases(self.aliases(other), results.aliases), f"{self.root}/{aliases}")
        return Version(
            other.number, {**other.dates, **dates}, dimension.removeprefix(f"{self.root}/"), aliases,
            f"{run}/reports/version=run",
        )

    # --- files ---------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs().exists(self._path(path))

    def _version_file(self, number: int) -> str:
        return f"{self.root}/versions/{number:012d}.json"

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/versions")
        fs = self._fs()
        if not fs.exists(folder):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(folder)]
        return [int(m[1]) for name in names if (m := re.fullmatch(r"(\d{12})\.json", name))]

    def _commit(self, version: Version) -> bool:
        """Whether this version now has its number; False if another has it."""
        fs, new = self._fs(), f"{self.root}/versions/.{uuid.uuid4().hex}.tmp"
        out = fs.create(self._path(new), False)
        out.write(json.dumps(asdict(version), sort_keys=True).encode())
        out.close()
        try:
            return self._renamed(new, self._version_file(version.number))
        finally:
            fs.delete(self._path(new), False)

    def _renamed(self, new: str, final: str) -> bool:
        uri = self._fs().makeQualified(self._path(final)).toUri()
        if uri.getScheme() == "file":
            # Linking fails where the name exists; a local rename would replace it.
            source = self._fs().makeQualified(self._path(new)).toUri().getPath()
            try:
                os.link(source, uri.getPath())
            except FileExistsError:
                return False
            return True
        jvm = self.spark._jvm
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        plain = self.spark.sparkContext._gateway.new_array(kind, 1)
        plain[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._path(new), self._path(final), plain)
        except Py4JJavaError as problem:
            if "FileAlreadyExistsException" in str(problem.java_exception):
                return False
            raise
        return True
