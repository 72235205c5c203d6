"""JDBC tables that readers never find half-written.

Executors write in many connections, so their rows can't be one transaction.
They go into a staging table; what readers see is switched by one connection of
the driver: a micro-batch is moved and noted in a ledger in one commit, and a
whole table is replaced by renaming. The database must have transactions
(InnoDB, not MyISAM, in MySQL).

Table names go into statements as they are, as Spark's own writer passes them
on. Statements are standard SQL but for the renames; MySQL and PostgreSQL have
their own form, other databases get delete and insert in one transaction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcast.sinks.writers import _connect, write_table

#: The micro-batches that a database holds: one row for each stream and table.
LEDGER = "lotcast_ledger"
LEDGER_SCHEMA = "stream_id string, table_name string, batch_id long"
STAGE, NEW, OLD = "_stage", "_new", "_old"


class _Session:
    """One connection with autocommit off: all of a block, or nothing."""

    def __init__(self, conn: Any) -> None:
        self.conn = conn
        self.quote = (conn.getMetaData().getIdentifierQuoteString() or "").strip()

    def __enter__(self) -> _Session:
        self.conn.setAutoCommit(False)
        return self

    def __exit__(self, kind, *_) -> None:
        try:
            if kind is None:
                self.conn.commit()
            else:
                self.conn.rollback()
        finally:
            self.conn.close()

    def column(self, name: str) -> str:
        q = self.quote
        return f"{q}{name.replace(q, q * 2) if q else name}{q}"

    def exists(self, table: str) -> bool:
        meta = self.conn.getMetaData()
        schema, _, name = table.rpartition(".")
        for spelled in (str, str.upper, str.lower):
            found = meta.getTables(None, spelled(schema) or None, spelled(name), None)
            there = found.next()
            found.close()
            if there:
                return True
        return False

    def run(self, sql: str, *values: str | int) -> None:
        stmt = self.conn.prepareStatement(sql)
        try:
            self._fill(stmt, values)
            stmt.executeUpdate()
        finally:
            stmt.close()

    def number(self, sql: str, *values: str | int) -> int | None:
        """The first column of the first row (None if NULL)."""
        stmt = self.conn.prepareStatement(sql)
        try:
            self._fill(stmt, values)
            rows = stmt.executeQuery()
            rows.next()
            value = rows.getLong(1)
            return None if rows.wasNull() else value
        finally:
            stmt.close()

    @staticmethod
    def _fill(stmt: Any, values: Sequence[str | int]) -> None:
        for i, value in enumerate(values, 1):
            (stmt.setLong if isinstance(value, int) else stmt.setString)(i, value)


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def jdbc_transaction_writer(table: str, options: dict[str, str], stream_id: str, batch_col: str = "batch_id",
                            stream_col: str = "stream_id", connect: Callable = _connect,
                            write: Callable = write_table) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer by which every micro-batch is in ``table``
    wholly or not at all, and once.

    The batch is written to a staging table of its stream. One transaction then
    copies it and notes its number in the ledger. A batch that runs again finds
    its number there and does nothing; if the first run died earlier, the table
    had none of its rows and the staging table is written anew. ``stream_id``
    must be as old as the checkpoint
    (:func:`lotcast.streaming.checkpoint_stream_id`).
    """
    stage = f"{table}{STAGE}_{stream_id[:8]}"
    last = f"SELECT max(batch_id) FROM {LEDGER} WHERE stream_id = ? AND table_name = ?"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumns({stream_col: F.lit(stream_id), batch_col: F.lit(int(batch_id)).cast("long")})
        # Tables are made before the transaction: in many databases making one commits.
        write(spark.createDataFrame([], LEDGER_SCHEMA), LEDGER, "jdbc", "append", options)
        with _Session(connect(spark, options)) as held:
            done = held.number(last, stream_id, table)
        if done is not None and done >= batch_id:
            return
        write(rows, stage, "jdbc", "overwrite", options)
        write(_empty(rows), table, "jdbc", "append", options)
        with _Session(connect(spark, options)) as db:
            done = db.number(last, stream_id, table)
            if done is not None and done >= batch_id:
                return
            columns = ", ".join(map(db.column, rows.columns))
            db.run(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}")
            db.run(f"DELETE FROM {LEDGER} WHERE stream_id = ? AND table_name = ?", stream_id, table)
            db.run(f"INSERT INTO {LEDGER} (stream_id, table_name, batch_id) VALUES (?, ?, ?)", stream_id, table, int(batch_id))

    return run


def replace_table(df: DataFrame, table: str, options: dict[str, str], connect: Callable = _connect,
                  write: Callable = write_table) -> None:
    """Overwrite a JDBC table so that readers find the old rows or the new
    ones at any time, whatever step fails.

    The rows are written to ``<table>_new``. Then PostgreSQL renames both tables
    in one transaction, MySQL in one statement; another database that has the
    table already empties and fills it in one transaction. What a failed
    run left behind goes with the next.
    """
    new, old = f"{table}{NEW}", f"{table}{OLD}"
    spark, url = df.sparkSession, options["url"]
    write(df, new, "jdbc", "overwrite", options)
    bare = table.rpartition(".")[2]
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        with _Session(connect(spark, options)) as db:
            if db.exists(old):  # left by a run that died after its switch
                db.run(f"DROP TABLE {old}")
            if db.exists(table):
                db.run(f"RENAME TABLE {table} TO {old}, {new} TO {table}")
                db.run(f"DROP TABLE {old}")
            else:
                db.run(f"RENAME TABLE {new} TO {table}")
    elif url.startswith("jdbc:postgresql:"):
        with _Session(connect(spark, options)) as db:
            if db.exists(table):
                db.run(f"ALTER TABLE {table} RENAME TO {bare}{OLD}")
                db.run(f"ALTER TABLE {new} RENAME TO {bare}")
                db.run(f"DROP TABLE {old}")
            else:
                db.run(f"ALTER TABLE {new} RENAME TO {bare}")
    else:
        write(_empty(df), table, "jdbc", "append", options)
        with _Session(connect(spark, options)) as db:
            columns = ", ".join(map(db.column, df.columns))
            db.run(f"DELETE FROM {table}")
            db.run(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {new}")
        with _Session(connect(spark, options)) as db:
            db.run(f"DROP TABLE {new}")
