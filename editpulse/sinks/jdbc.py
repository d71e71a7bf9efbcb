"""Landing into a database through JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows per insert batch of the stream and of the monthly batch load.
STREAM_BATCH_SIZE = 1000
MONTHLY_BATCH_SIZE = 10000


def jdbc_options(
    url: str, table: str, user: str, password: str, batch_size: int, driver: str | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password, "batchsize": str(batch_size)}
    if driver:
        options["driver"] = driver
    return options


def postgres_url(host: str, port: int, database: str, untyped_strings: bool = False) -> str:
    """``untyped_strings`` lets the server take text for JSON columns."""
    suffix = "?stringtype=unspecified" if untyped_strings else ""
    return f"jdbc:postgresql://{host}:{port}/{database}{suffix}"


def append_jdbc(rows: DataFrame, options: dict[str, str], connections: int | None = None) -> None:
    """Append rows, one connection per partition; ``connections`` limits how many there are."""
    if connections:
        rows = rows.coalesce(connections)
    rows.write.format("jdbc").mode("append").options(**options).save()
