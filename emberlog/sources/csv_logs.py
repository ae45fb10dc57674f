"""CSV logs: files with different headers are read per header and merged by column name.

Everything is read as text. Inferring types would need another pass over the data and turns a bare time of day into
a timestamp of today.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from emberlog.config import BATCH, ParseProfile
from emberlog.operators import clean
from emberlog.schema import RAW

log = logging.getLogger(__name__)

HEADERS = "path string, header string"
REJECTS = "source_file string, record string, reason string, fields int, expected int"
# Characters that a header probe decodes at once, and the size up to which a file is simply read to its end.
PROBE_CHARS = 1 << 16
SMALL_FILE = 1 << 20
# Fields of a record at most; one with more makes Spark's parser fail the job.
MOST_FIELDS = 1 << 19
RECORD = "_record"


def list_files(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", recursive: bool = False
) -> list[str]:
    """URIs of the files below the paths by Spark's own listing; a path that does not exist counts as empty."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found: list[str] = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            found += reader.text(path).inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no such path: %s", path)
    return sorted(set(found))


def readable_path(uri: str) -> str:
    """A listed URI as a path for a reader: decoded, and with glob characters taken literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def same_file_key(uri: Column) -> Column:
    """A URI in the one spelling shared by file listings and the ``_metadata`` column."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def path_key(uri: str) -> str:
    """``same_file_key`` for the driver."""
    return re.sub("^file:/+", "file:/", uri)


def _first_records(multi_line: bool):
    """The task function that finds the first record with text of each file and then stops reading it.

    It is built inside a function so that it travels to the executors by value; they need not have this package.
    """
    import pyarrow as pa

    small = SMALL_FILE

    def probe(batches):
        current, lines, done = None, [], False
        for batch in batches:
            for path, size, line in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if path != current:
                    if lines and not done:
                        yield pa.RecordBatch.from_pydict({"path": [current], "header": ["\n".join(lines)]})
                    current, lines, done = path, [], False
                if done:
                    if size > small:
                        return
                    continue
                line = (line or "").removeprefix("\ufeff")
                if not lines and not line.strip():
                    continue
                lines.append(line)
                if not multi_line or "".join(lines).count('"') % 2 == 0:  # no line break inside quotes
                    done = True
                    yield pa.RecordBatch.from_pydict({"path": [current], "header": ["\n".join(lines)]})
        if lines and not done:
            yield pa.RecordBatch.from_pydict({"path": [current], "header": ["\n".join(lines)]})

    return probe


def file_headers(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """(path, header) of each file that has a line with text, on any file system that Spark reads.

    Every file is a task of its own, whose input is an unsplit stream of lines. The task asks for the first few and ends, so not
    much more than ``PROBE_CHARS`` of a file are read however large it is. Files that can't be read give no row.
    """
    if not paths:
        return spark.createDataFrame([], HEADERS)
    # Of a session of its own, whose settings concern nothing but this read.
    probing = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        probing.conf.set(f"spark.sql.files.{name}", str(1 << 27))
    probing.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = (
        probing.read.schema("value string")
        .option("multiLine", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("inputBufferSize", PROBE_CHARS)
        .option("ignoreCorruptFiles", True)
        .csv([readable_path(path) for path in paths])
    )
    described = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), "value")
    return described.mapInArrow(_first_records(multi_line), HEADERS)


def file_states(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", recursive: bool = False
) -> DataFrame:
    """(path, modified, bytes) of each file below the paths, as Spark's own listing has them; contents aren't read."""
    files = list_files(spark, paths, glob, recursive)
    if not files:
        return spark.createDataFrame([], "path string, modified timestamp, bytes long")
    listed = spark.read.format("binaryFile").load([readable_path(path) for path in files])
    return listed.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def group_by_header(spark: SparkSession, paths: list[str], multi_line: bool = False) -> dict[str, list[str]]:
    """Paths per header line. Unreadable and empty files are left out with a warning.

    What reaches the driver is one short row per file, of the same order as Spark's own file listing. The files are probed
    by one job, in parallel; an iterator over the rows would run a job per file, one after another.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    left = {path_key(path): path for path in paths}
    for row in file_headers(spark, paths, multi_line).collect():
        groups[row.header].append(left.pop(path_key(row.path)))
    for path in left.values():
        log.warning("skipped empty or unreadable file: %s", path)
    return {header: sorted(groups[header]) for header in sorted(groups)}


def _records(spark: SparkSession, paths: list[str], n_fields: int, multi_line: bool) -> DataFrame:
    """Records of files of one header by position, with the whole text of those that don't fit it as ``RECORD``."""
    fields = [T.StructField(f"_{i}", T.StringType()) for i in range(n_fields)]
    return (
        spark.read.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())]))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)  # else only as many fields are looked at as are asked for
        .option("maxColumns", MOST_FIELDS)
        .option("multiLine", multi_line)
        .csv([readable_path(path) for path in paths])
    )


def _record() -> Column:
    """The text of a record that doesn't fit. Spark gives it only to those who ask for a column of the file besides."""
    return F.coalesce(RECORD, "_0")


def _field_count() -> Column:
    """Fields of a record's text: separators outside quotes, and one. Only a quote at the start of a field encloses it."""
    closed = F.regexp_replace(_record(), '(^|,)"([^"]|"")*+"', "$1")
    plain = F.regexp_replace(closed, '(?s)(^|,)".*$', "$1")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def _rejected(n_fields: int, strict: bool) -> Column:
    """Whether a record can't be a row: it has more fields than the header, or with ``strict`` another number of them."""
    return F.col(RECORD).isNotNull() & (_field_count() > (0 if strict else n_fields))


def header_names(header: str) -> list[str | None]:
    return clean.unique_names(next(csv.reader([header])))


def read_one_header(
    spark: SparkSession,
    paths: list[str],
    header: str,
    multi_line: bool = False,
    keep_path: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Files that share one header line, as text columns with lower-case names; of equal names the first is kept.

    A record with more fields than the header is no row but one of ``read_rejects``: cut to the header it would lose what it
    says. Missing fields at the end are null, unless ``strict`` makes such records rejects too. ``keep_path`` adds the file each
    row came from as ``source_file``.
    """
    names = header_names(header)
    df = _records(spark, paths, len(names), multi_line).filter(~_rejected(len(names), strict))
    named = [(f"_{i}", name if name else f"_c{i}") for i, name in enumerate(names) if name is not None]
    source = [same_file_key(F.col("_metadata.file_path")).alias("source_file")] if keep_path else []
    return df.select(*[F.col(p).alias(name) for p, name in named], *source)


def rejects_of_one_header(
    spark: SparkSession, paths: list[str], header: str, multi_line: bool = False, strict: bool = False
) -> DataFrame:
    """The records that ``read_one_header`` leaves out: file, text, reason (``long`` or ``short``), fields found and expected."""
    n = len(header_names(header))
    rejected = _records(spark, paths, n, multi_line).filter(_rejected(n, strict))
    count = _field_count()
    return rejected.select(
        same_file_key(F.col("_metadata.file_path")).alias("source_file"),
        _record().alias("record"),
        F.when(count > n, "long").otherwise("short").alias("reason"),
        count.cast("int").alias("fields"),
        F.lit(n).alias("expected"),
    )


def rejects_of_groups(
    spark: SparkSession, groups: dict[str, list[str]], multi_line: bool = False, strict: bool = False
) -> DataFrame:
    """The rejects of files given per header line."""
    frames = [rejects_of_one_header(spark, files, header, multi_line, strict) for header, files in groups.items()]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], REJECTS)


def standard_columns(df: DataFrame, profile: ParseProfile = BATCH) -> DataFrame:
    """Canonical names and an assembled text timestamp, still otherwise raw."""
    return clean.assemble_timestamp(clean.rename_aliases(df), profile.strip_brackets)


def merge_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name, absent columns becoming null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_grouped(
    spark: SparkSession,
    groups: dict[str, list[str]],
    profile: ParseProfile = BATCH,
    multi_line: bool = False,
    keep_path: bool = False,
    strict: bool = False,
) -> DataFrame:
    """CSV files, given per header line, as one raw table; without any file, an empty one with the required columns."""
    frames = [
        standard_columns(read_one_header(spark, files, header, multi_line, keep_path, strict), profile)
        for header, files in groups.items()
    ]
    return merge_by_name(frames) if frames else spark.createDataFrame([], RAW)


def read_files(
    spark: SparkSession,
    paths: list[str],
    profile: ParseProfile = BATCH,
    multi_line: bool = False,
    keep_path: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Listed CSV files as one raw table; a file that can't be read to its end fails the job that reads it."""
    return read_grouped(spark, group_by_header(spark, paths, multi_line), profile, multi_line, keep_path, strict)


def read_csv_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    profile: ParseProfile = BATCH,
    header: bool = True,
    glob: str | None = "*.csv",
    recursive: bool = False,
    multi_line: bool = False,
    strict: bool = False,
) -> DataFrame:
    """CSV files and directories as one raw table with canonical names and a text timestamp.

    Records that don't fit their file's header are those of ``read_rejects`` with the same arguments.
    """
    files = list_files(spark, paths, glob, recursive)
    if header or not files:
        return read_files(spark, files, profile, multi_line, strict=strict)
    plain = spark.read.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    return clean.lower_columns(plain.csv([readable_path(path) for path in files]))


def read_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = "*.csv",
    recursive: bool = False,
    multi_line: bool = False,
    strict: bool = False,
) -> DataFrame:
    """(source_file, record, reason, fields, expected) of every record that ``read_csv_logs`` leaves out."""
    files = list_files(spark, paths, glob, recursive)
    return rejects_of_groups(spark, group_by_header(spark, files, multi_line), multi_line, strict)
