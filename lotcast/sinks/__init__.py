"""Sinks: files, JDBC, Kafka, publishing by rename."""

from lotcast.sinks.jdbc import jdbc_transaction_writer, replace_table
from lotcast.sinks.writers import jdbc_batch_writer, jdbc_options, write_kafka, write_table

__all__ = ["jdbc_batch_writer", "jdbc_options", "jdbc_transaction_writer", "replace_table", "write_kafka", "write_table"]
