"""Raw ingestion: text files kept as text, with the time and file each row came from."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import PARQUET_OPTIONS
from martloom.sources import paths, records
from martloom.sources.registry import SOURCES, TableSpec

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
LINEAGE = (INGESTED_AT, SOURCE_FILE)
CORRUPT = "_corrupt_record"

# Header row, doubled quotes inside quoted fields.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def parallel(
    spark: SparkSession, jobs: Mapping[str, Callable[[], object]], workers: int = 4
) -> dict:
    """Run independent Spark actions side by side, so small ones do not queue behind large ones."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def require_sources(spark: SparkSession, raw_dir: str, specs: Iterable[TableSpec]) -> None:
    """One error naming every source without files, before anything is read."""
    missing = [s.files for s in specs if not paths.glob(spark, paths.join(raw_dir, s.files))]
    if missing:
        raise FileNotFoundError(f"no files in {raw_dir} for: {', '.join(missing)}")


def first_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """file, line: the first line of each file that has one, compressed or not.

    One scan of the files' first splits as text, in tasks; nothing is opened from the driver.
    """
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    return first.select("file", F.regexp_replace("line", "^\ufeff", "").alias("line"))


def _one_slash(path: str) -> str:
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def _given(found: str, known: Mapping[str, str]) -> str:
    """The key of ``known`` for a path of Spark's metadata, where some characters are written as %xx."""
    plain = _one_slash(found)
    return plain if plain in known else unquote(plain)


def split_files(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The files of a source with line breaks in fields that many tasks can read."""
    large = {_one_slash(f): f for f in records.larger_than_a_split(spark, files)}
    for found in records.unfit(spark, list(large.values())) if large else []:
        large.pop(_given(found, large))
    return [f for f in files if _one_slash(f) in large]


def read_headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names in their first line; a file without lines has none."""
    known = {_one_slash(f): f for f in files}
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first_lines(spark, files).collect() if files else []:
        file = known.pop(_given(row["file"], known))
        names = tuple(next(csv.reader([row["line"]]), ())) if row["line"] else ()
        groups.setdefault(names, []).append(file)
    if known:
        groups.setdefault((), []).extend(known.values())
    return {names: sorted(located) for names, located in groups.items()}


def read_raw(
    spark: SparkSession,
    raw_dir: str,
    spec: TableSpec,
    *,
    keep_malformed: bool = False,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """All-string rows plus lineage, of all (or the given) files of a source.

    Every file is read by the names in its own header, so the order of columns may differ
    between files; a column that a file lacks is NULL there, except for the columns the spec
    declares, whose absence is an error that names the file. Files of no bytes are passed over. With ``keep_malformed`` short, long
    or broken rows carry their text in ``_corrupt_record``. A file of a ``multi_line`` source that is
    larger than a split is read by many tasks if its quotes tell its records (``records.unfit``,
    looked up while the query is built), else by one.
    """
    known = paths.data_files(spark, paths.join(raw_dir, spec.files))
    groups = read_headers(spark, known if files is None else files or known[:1])
    if not groups:
        raise ValueError(f"no file of {spec.files} in {raw_dir} has a header")
    for names, located in groups.items():
        if absent := [c for c in spec.columns if c not in names]:
            raise ValueError(f"{located[0]}: the header lacks {', '.join(absent)}")
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", spec.multi_line)
    if keep_malformed:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)

    def read(names: tuple[str, ...], located: list[str]) -> DataFrame:
        cut = split_files(spark, located) if spec.multi_line else []
        whole = [f for f in located if f not in cut]
        parts = [read_whole(names, whole)] if whole else []
        if cut:
            rows = records.read_records(spark, cut, names, CORRUPT if keep_malformed else None)
            kept, name = [F.col(f"`{c}`") for c in rows.columns[:-1]], F.col(rows.columns[-1])
            parts.append(rows.select(*kept, F.current_timestamp().alias(INGESTED_AT), name.alias(SOURCE_FILE)))
        return reduce(DataFrame.union, parts)

    def read_whole(names: tuple[str, ...], located: list[str]) -> DataFrame:
        fields = [T.StructField(n, T.StringType()) for n in names]
        if keep_malformed:
            fields.append(T.StructField(CORRUPT, T.StringType()))
        return reader.schema(T.StructType(fields)).csv(located).select(
            "*",
            F.current_timestamp().alias(INGESTED_AT),
            F.col("_metadata.file_name").alias(SOURCE_FILE),
        )

    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [read(names, located) for names, located in sorted(groups.items())],
    )
    if len(groups) > 1:
        added = {INGESTED_AT, SOURCE_FILE, CORRUPT}
        rows = rows.select(
            *[c for c in rows.columns if c not in added], *[c for c in rows.columns if c in added]
        )
    return rows.where("false") if files is not None and not files else rows


def write_counted(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> int:
    """Write and return the row count seen by the write itself.

    The metric sits in the last stage, where Spark counts each task once even when
    an executor is lost and earlier stages run again.
    """
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").options(
        **PARQUET_OPTIONS
    ).partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def ingest(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    specs: Mapping[str, TableSpec] = SOURCES,
    *,
    keep_malformed: bool = False,
    files: Mapping[str, Sequence[str]] | None = None,
    workers: int = 4,
) -> dict[str, int]:
    """Land every source as Parquet; returns rows per source.

    ``files`` names the files to land of some sources; ``workers`` sources are landed at once.
    """
    require_sources(spark, raw_dir, specs.values())

    def land(spec: TableSpec):
        chosen = (files or {}).get(spec.name)
        # A lookup without a key is never judged, so it has no use for broken rows.
        strict = keep_malformed and bool(spec.key)

        def job():
            rows = read_raw(spark, raw_dir, spec, keep_malformed=strict, files=chosen)
            return write_counted(rows, paths.join(out_dir, spec.name))

        return job

    return parallel(spark, {name: land(spec) for name, spec in specs.items()}, workers)
