"""Sources: typed batch reads and Kafka options."""

from lotcast.sources.readers import kafka_options, read_listings, read_table

__all__ = ["kafka_options", "read_listings", "read_table"]
