"""Registration of queries together with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables
from emberlog.plans.parse import parse_logs

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Inputs:
    """The tables a query may start from, all lazy and covering every row of ``events``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The log timestamps are UTC wall-clock times.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        """Log rows before cleaning, with entities and with gaps in the timestamps."""
        return tables.raw_logs(self.rows)

    @cached_property
    def messages(self) -> DataFrame:
        """Log rows without the columns that can be derived from the message."""
        return self.rows.drop("ip_address", "service_name")

    @cached_property
    def rows(self) -> DataFrame:
        return tables.logs(tables.events(self.spark, self.sf_dir))

    @cached_property
    def logs(self) -> DataFrame:
        """Parsed log rows."""
        return parse_logs(self.rows)

    @cached_property
    def alerts(self) -> DataFrame:
        return tables.alerts(self.rows)

    @cached_property
    def history(self) -> DataFrame:
        return tables.history(self.rows)

    def scratch(self) -> str:
        """A fresh directory on shared storage: below the checkpoint folder, or else the warehouse."""
        conf = self.spark.conf
        shared = conf.get("spark.checkpoint.dir", None) or f"{conf.get('spark.sql.warehouse.dir')}/scratch"
        return f"{shared.rstrip('/')}/{tables.fresh_name()}"


@lru_cache(maxsize=4)
def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The lazy tables of a session and directory, so that their plans are analysed once and not per query."""
    return Inputs(spark, sf_dir)


def edge(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, which is how the SQL side sees them."""
    changed = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(changed)


def register(name: str, sql: str | None = None) -> Callable:
    """Register a function of :class:`Inputs` under a name; ``sql`` may use the common tables of ``tables.SQL``."""

    def add(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: edge(function(inputs(spark, sf_dir)))
        if sql is not None:
            _SQL[name] = tables.with_tables(sql)
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
