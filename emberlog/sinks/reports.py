"""Report files. Results keep as many files as they have partitions; one-row and top-n results can be put in one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text form of timestamps in text reports.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def flat_columns(df: DataFrame) -> DataFrame:
    """Maps, arrays and structs as JSON text, which is all a CSV cell can hold."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("map", "array", "struct")]
    return df.withColumns({name: F.to_json(name) for name in nested})


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with a header line, text kept with its blanks; ``single_file`` is for results of bounded size."""
    out = flat_columns(df.coalesce(1) if single_file else df)
    (
        out.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def export_json(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """JSON, one object per line; ``single_file`` is for results of bounded size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("timestampFormat", TIMESTAMP_FORMAT).json(path)


def export_json_array(df: DataFrame, path: str, mode: str = "overwrite", records: int = 1000) -> None:
    """JSON arrays with times as epoch milliseconds: each line is an array of at most ``records`` rows."""
    rows = df.select(
        *[
            F.unix_millis(F.col(f.name).cast("timestamp")).alias(f.name)
            if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
            else F.col(f.name)
            for f in df.schema
        ]
    )
    # Ids are consecutive within a partition, so a group never holds more.
    numbered = rows.select(F.struct(*rows.columns).alias("row"), F.monotonically_increasing_id().alias("n"))
    parts = numbered.groupBy(F.floor(F.col("n") / records).alias("part"))
    parts.agg(F.to_json(F.collect_list("row")).alias("value")).select("value").write.mode(mode).text(path)


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet in as many files as there are partitions."""
    df.write.mode(mode).parquet(path)
