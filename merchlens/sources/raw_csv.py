"""Raw CSV scans: every column text, only an empty field missing.

Files are parsed once, while they are ingested into columns. Rows that do not fit the header are kept with their text,
file and reason.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.sources import quoted_csv
from merchlens.sources.jobs import side_by_side
from merchlens.sources.quoted_csv import RawDataError
from merchlens.sources.schemas import RAW_COLUMNS, RAW_FILES, ROW_ORDER

# Columns beside those of the header: the text of a row that does not fit it, and the file the row comes from.
MALFORMED, FILE = "_malformed", "_file"
REJECTED = "_rejected"
REASONS = ("quoted line break", "too few fields", "too many fields")


@dataclass(frozen=True)
class RawFolder:
    """A folder of raw datasets, each a CSV file, a glob of files or a sub-folder of part files.

    Large files are split between tasks, and a line is a row; a quoted line break shows as rows that do not fit, which
    are reported. `multiline` allows line breaks inside quoted fields, which makes a file one unit of work, and
    `joined` allows them in files that are split (see `quoted_csv`).
    """

    path: str
    files: Mapping[str, str] = field(default_factory=lambda: dict(RAW_FILES))
    multiline: bool = False
    joined: bool = False

    def location(self, dataset: str) -> str:
        if dataset not in self.files:
            raise KeyError(f"Unknown dataset '{dataset}'. Expected one of: {sorted(self.files)}")
        return f"{self.path.rstrip('/')}/{self.files[dataset]}"

    def header(self, spark: SparkSession, dataset: str) -> list[str]:
        """The column names of a dataset; without schema inference only the header is read."""
        return self._reader(spark).csv(self.location(dataset)).columns

    def read(self, spark: SparkSession, dataset: str, ordered: bool = False) -> DataFrame:
        """All columns of one dataset as text, named after its header, rows that do not fit it included.

        `enforceSchema=false` makes every part file prove that its header agrees, instead of being read by position.
        `ordered` adds the place of each row in the files, taken in order of their paths.
        """
        if self.joined:
            data = self.parsed(spark, dataset)
            return data.drop(MALFORMED, FILE) if ordered else data.drop(MALFORMED, FILE, ROW_ORDER)
        data = self._reader(spark).csv(self.location(dataset))
        return data.select("*", _place()) if ordered else data

    def parsed(self, spark: SparkSession, dataset: str) -> DataFrame:
        """The rows of `read` with their place, their file and, where they do not fit the header, their text."""
        names = self.header(spark, dataset)
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])
        if self.joined:
            records = quoted_csv.records(spark, self.location(dataset), names)
            options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
            fields = F.from_csv("record", ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names), options)
            place = F.struct(F.col("file").alias("file_path"), F.col("number.split").alias("file_block_start"), F.col("number.nth").alias("line"))
            return records.select(fields.alias("fields"), F.col("file").alias(FILE), place.alias(ROW_ORDER)).select("fields.*", FILE, ROW_ORDER)
        # Without pruning, since a parser that skips fields does not miss any.
        reader = self._reader(spark).schema(schema).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        return reader.csv(self.location(dataset)).select("*", F.col("_metadata.file_path").alias(FILE), _place())

    def ingest(self, spark: SparkSession, dataset: str, folder: str, ordered: bool = False) -> dict[str, int]:
        """Parse one dataset once into columns under `folder`; returns the number of rows rejected for each reason.

        Rejected rows are kept among the others, with their text and file.
        """
        data = self.parsed(spark, dataset).withColumn(REJECTED, F.col(MALFORMED).isNotNull())
        names = [c for c in data.columns if c not in (MALFORMED, FILE, REJECTED, ROW_ORDER)]
        reason = _reason(F.col(MALFORMED), len(names))
        seen = Observation()
        counts = [F.count_if(F.col(REJECTED) & (reason == r)).alias(r) for r in REASONS]
        written = data.observe(seen, *counts) if ordered else data.drop(ROW_ORDER).observe(seen, *counts)
        written.write.mode("overwrite").parquet(folder)
        return {r: seen.get[r] for r in REASONS}

    def ingested(self, spark: SparkSession, dataset: str, folder: str, ordered: bool = False, files: bool = False) -> DataFrame:
        """The ingested rows of one dataset that fit its header, with the file of each if `files` is set."""
        data = spark.read.parquet(folder).where(~F.col(REJECTED)).drop(MALFORMED, REJECTED)
        data = data if files else data.drop(FILE)
        return data if ordered or ROW_ORDER not in data.columns else data.drop(ROW_ORDER)

    def rejected(self, spark: SparkSession, dataset: str, folder: str) -> DataFrame:
        """The ingested rows that do not fit: dataset, file, reason, record."""
        data = spark.read.parquet(folder)
        names = [c for c in data.columns if c not in (MALFORMED, FILE, REJECTED, ROW_ORDER)]
        return data.where(REJECTED).select(
            F.lit(dataset).alias("dataset"), F.col(FILE).alias("file"), _reason(F.col(MALFORMED), len(names)).alias("reason"),
            F.col(MALFORMED).alias("record"),
        )

    def versions(self, spark: SparkSession, dataset: str) -> dict[str, str]:
        """The files of a dataset with a name for each as it is now, which changes whenever the file does."""
        found = spark.read.format("binaryFile").load(self.location(dataset)).select(
            "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
        )
        return {r[0]: hashlib.sha256(repr((dataset, r[0], r[1], str(r[2]))).encode()).hexdigest()[:32] for r in found.collect()}

    def fingerprint(self, spark: SparkSession) -> str:
        """Changes whenever a file is added, removed, grown, shortened or written again."""
        digest = hashlib.sha256(f"{self.multiline} {self.joined}".encode())
        for dataset in sorted(self.files):
            try:
                listed = spark.read.format("binaryFile").load(self.location(dataset)).select("path", "length", "modificationTime")
                files = sorted((r.path, r.length, str(r.modificationTime)) for r in listed.collect())
            except AnalysisException:
                files = []
            digest.update(repr((dataset, files)).encode())
        return digest.hexdigest()[:32]

    def _reader(self, spark: SparkSession) -> DataFrameReader:
        return (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", self.multiline)
            .option("enforceSchema", False)
            .option("encoding", "UTF-8")
        )

    def read_all(self, spark: SparkSession, datasets: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return {dataset: self.read(spark, dataset) for dataset in self._names(datasets)}

    def inspect(self, spark: SparkSession, datasets: Iterable[str] | None = None) -> tuple[dict[str, int], list[str]]:
        """Size in bytes per usable dataset, and every problem that listings and headers show; no row is parsed."""
        sizes: dict[str, int] = {}
        problems: list[str] = []
        for dataset in self._names(datasets):
            location = self.location(dataset)
            size = self._size(spark, location)
            if size is None:
                problems.append(f"{dataset}: file not found at {location}")
            elif size == 0:
                problems.append(f"{dataset}: file is empty ({location})")
            else:
                absent = sorted(set(RAW_COLUMNS[dataset]) - set(self.header(spark, dataset)))
                if absent:
                    problems.append(f"{dataset}: missing expected columns {absent}")
                else:
                    sizes[dataset] = size
        return sizes, problems

    def check(self, spark: SparkSession, datasets: Iterable[str] | None = None) -> dict[str, int]:
        """Size in bytes per dataset; raises once with every problem found, rows that do not fit their header included.

        Parses the text without keeping it; a run finds the same problems while it ingests.
        """
        sizes, problems = self.inspect(spark, datasets)

        def malformed(dataset: str) -> int:
            data = self.parsed(spark, dataset)
            every = [F.count(F.col(f"`{c}`")) for c in data.columns if c not in (MALFORMED, FILE, ROW_ORDER)]
            return data.agg(F.count_if(F.col(MALFORMED).isNotNull()).alias("rows"), *every).first().rows

        counts = side_by_side(spark, malformed, sizes)
        problems += [f"{dataset}: {rows} rows with too many or too few fields" for dataset, rows in zip(sizes, counts) if rows]
        if problems:
            raise RawDataError("Raw data check failed:\n" + "\n".join(problems))
        return sizes

    def _names(self, datasets: Iterable[str] | None) -> list[str]:
        return list(datasets) if datasets is not None else list(self.files)

    @staticmethod
    def _size(spark: SparkSession, location: str) -> int | None:
        """Total bytes at a location from the file listing alone; the contents are pruned from the scan."""
        try:
            listing = spark.read.format("binaryFile").load(location)
        except AnalysisException:
            return None
        # Empty files are not listed at all.
        return listing.agg(F.sum("length")).first()[0] or 0


def _place() -> Column:
    # Within a split the id grows from row to row, whatever order the splits are read in.
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias(ROW_ORDER)


def _reason(record: Column, fields: int) -> Column:
    """Why a row does not fit: a quote that its line does not close, or its number of fields."""
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    found = F.size(F.split(F.regexp_replace(record, '"[^"]*"', ""), ","))
    return F.when(quotes % 2 == 1, REASONS[0]).when(found < fields, REASONS[1]).otherwise(REASONS[2])
