"""Streaming use of the stateless silver step."""

from .landing import stream_bronze, stream_silver

__all__ = ["stream_bronze", "stream_silver"]
