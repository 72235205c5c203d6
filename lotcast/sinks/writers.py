"""Sinks: Parquet, CSV, JDBC and Kafka through the DataFrameWriter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcast.functions.codec import encode_messages


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int | None = None,
                 truncate: bool | None = None, num_partitions: int | None = None,
                 **extra: str) -> dict[str, str]:
    """Options for a JDBC table. No defaults for host or credentials.

    ``num_partitions`` caps the concurrent connections (Spark coalesces to
    it before writing); ``truncate`` keeps the table definition on
    overwrite instead of dropping it.
    """
    opts = {"url": url}
    for key, val in (("user", user), ("password", password), ("driver", driver),
                     ("batchsize", batchsize), ("numPartitions", num_partitions)):
        if val is not None:
            opts[key] = str(val)
    if truncate is not None:
        opts["truncate"] = "true" if truncate else "false"
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                options: dict | None = None, partition_by: Sequence[str] = ()) -> None:
    """Write a DataFrame to a folder (parquet/csv/json/orc) or a JDBC table.

    For ``fmt="jdbc"``, ``target`` is the table name and ``options`` must
    hold at least ``url`` (see :func:`jdbc_options`). CSV is written with
    a header row.
    """
    opts = dict(options or {})
    writer = df.write.mode(mode)
    if fmt == "jdbc":
        writer.format("jdbc").options(dbtable=target, **opts).save()
        return
    if fmt == "csv":
        opts.setdefault("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).options(**opts).save(target)


def write_kafka(df: DataFrame, options: dict[str, str], columns: Sequence[str] | None = None,
                key: str | None = None) -> None:
    """Export rows as string-valued JSON messages to a Kafka topic
    (``options`` needs ``kafka.bootstrap.servers`` and ``topic``).
    Needs the Kafka connector on the classpath."""
    encode_messages(df, columns, key).write.format("kafka").options(**options).save()


def _connect(spark, options: dict[str, str]):
    """A connection on the driver. A driver named in the options is taken
    from the class loader that also sees ``--jars``."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            props.setProperty(key, options[key])
    if "driver" in options:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = loader.loadClass(options["driver"]).getDeclaredConstructor().newInstance()
        return driver.connect(options["url"], props)
    return jvm.java.sql.DriverManager.getConnection(options["url"], props)


def delete_batch(conn, table: str, keys: dict[str, str | int]) -> bool:
    """Delete the rows of ``table`` (``name`` or ``schema.name``) whose key
    columns have these values. False if there is no such table yet. Names are
    quoted as the database wants; the table is found under its own spelling or
    in the database's upper or lower case."""
    meta = conn.getMetaData()
    quote = (meta.getIdentifierQuoteString() or "").strip()
    schema, _, name = table.rpartition(".")
    for spelled in (str, str.upper, str.lower):
        found = meta.getTables(None, spelled(schema) or None, spelled(name), None)
        exists = found.next()
        found.close()
        if exists:
            break
    else:
        return False

    def quoted(part: str) -> str:
        return f"{quote}{part.replace(quote, quote * 2) if quote else part}{quote}"

    target = ".".join(quoted(spelled(p)) for p in (schema, name) if p)
    where = " AND ".join(f"{key} = ?" for key in keys)
    stmt = conn.prepareStatement(f"DELETE FROM {target} WHERE {where}")
    for i, value in enumerate(keys.values(), 1):
        (stmt.setLong if isinstance(value, int) else stmt.setString)(i, value)
    stmt.executeUpdate()
    stmt.close()
    return True


def jdbc_batch_writer(table: str, options: dict[str, str], stream_id: str, batch_col: str = "batch_id",
                      stream_col: str = "stream_id", connect=_connect):
    """A ``foreachBatch`` writer that makes JDBC appends idempotent.

    Rows carry ``stream_col`` and ``batch_col``. Before appending micro-batch
    ``N`` of this stream it deletes the rows of the same stream and batch, so
    a batch replayed after a failure replaces its earlier, possibly partial,
    rows. ``stream_id`` must be as old as the checkpoint: a new checkpoint
    counts batches from 0 again and needs a new id, or it would delete an
    earlier run's rows (:func:`lotcast.streaming.checkpoint_stream_id` keeps
    one beside the checkpoint). Use with
    :func:`lotcast.streaming.score_stream_each_batch`, which adds the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        conn = connect(batch.sparkSession, options)
        try:
            delete_batch(conn, table, {stream_col: stream_id, batch_col: int(batch_id)})
        finally:
            conn.close()
        write_table(batch.withColumn(stream_col, F.lit(stream_id)), table, "jdbc", "append", options)

    return write
