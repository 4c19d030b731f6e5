"""Structured Streaming forms of the loads."""

from barhouse.streaming.bronze_stream import stream_bronze
from barhouse.streaming.silver_stream import stream_silver

__all__ = ["stream_bronze", "stream_silver"]
