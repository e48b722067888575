"""Bounded reads: JDBC, NoSQL connectors, file trees, Kafka topics."""
