"""Streaming jobs: the batch operators on streaming sources and sinks."""
