"""Structured Streaming form of the class statistics."""

from tablelearn.streaming.incremental import labelled_stream, start_class_statistics

__all__ = ["labelled_stream", "start_class_statistics"]
