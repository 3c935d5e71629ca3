"""Streaming: request consumer with dead letters (Structured Streaming)."""

from .requests import REASON_SOURCE_ERROR, process_batch, publish_requests, request_source, start_request_stream

__all__ = ["REASON_SOURCE_ERROR", "process_batch", "publish_requests", "request_source", "start_request_stream"]
