from chatloom.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]
