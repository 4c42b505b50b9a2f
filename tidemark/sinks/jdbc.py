"""K4: JDBC writes (append/overwrite into a schema-qualified table).

Credentials are arguments, never constants in code. ``num_partitions`` bounds the
number of concurrent connections and ``batch_size`` the rows per round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_url(host: str, port: int, database: str, schema: str | None = None,
             engine: str = "postgresql") -> str:
    """``jdbc:<engine>://host:port/database`` with the default schema when given."""
    url = f"jdbc:{engine}://{host}:{port}/{database}"
    return f"{url}?currentSchema={schema}" if schema else url


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, num_partitions: int | None = None,
                 batch_size: int | None = None, schema: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": f"{schema}.{table}" if schema and "." not in table else table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if batch_size:
        opts["batchsize"] = str(batch_size)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    df.write.format("jdbc").options(**jdbc_options(url, table, **kw)).mode(mode).save()
