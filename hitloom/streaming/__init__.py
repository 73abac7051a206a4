from hitloom.streaming.ingest import ingest_new_files, raw_stream

__all__ = ["ingest_new_files", "raw_stream"]
