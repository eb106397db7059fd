"""Incremental (Structured Streaming) ingestion over the same schemas and row rules."""

from marginlens.streaming.ingest import ingest, read_orders_stream, read_products_stream, row_rules

__all__ = ["ingest", "read_orders_stream", "read_products_stream", "row_rules"]
