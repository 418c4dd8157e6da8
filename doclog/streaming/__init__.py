"""Streaming writes into logs and collections."""

from .sinks import follow_log, write_collection, write_ledger, write_log

__all__ = ["follow_log", "write_collection", "write_ledger", "write_log"]
