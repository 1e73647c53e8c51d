"""Streaming: incremental ingest of arriving session sheets (``latest``)."""
