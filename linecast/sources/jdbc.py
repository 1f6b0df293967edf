"""JDBC tables (SRC2-SRC4, SNK1, SNK3).

No database may be started in this environment, so these functions have no
end-to-end test here; they only wrap Spark's JDBC data source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def hash_predicates(column: str, n: int) -> list[str]:
    """Disjoint, complete predicates that split a table into ``n`` parts by an
    integer column: ``((c % n) + n) % n = i`` also places negative ids, and
    null ids get their own part (B1)."""
    parts = [f"(({column} % {n}) + {n}) % {n} = {i}" for i in range(n)]
    return parts + [f"{column} IS NULL"]


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               predicates: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Whole-table read; with ``predicates`` one partition per predicate
    (``read.jdbc(predicates=...)``: the form that really partitions). Column
    selection and simple filters on the result are pushed into the SQL."""
    if predicates:
        df = spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    else:
        df = spark.read.jdbc(url, table, properties=properties)
    return df.select(*columns) if columns else df


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                 batch_size: int = 100, max_connections: int | None = None) -> None:
    """Executor-side batched append (replaces the driver-side insert loop);
    ``max_connections`` bounds concurrent connections to the database (a
    repartition: coalescing would run the whole upstream stage in as few tasks)."""
    out = df.repartition(max_connections) if max_connections else df
    props = dict(properties, batchsize=str(batch_size))
    out.write.mode("append").jdbc(url, table, properties=props)
