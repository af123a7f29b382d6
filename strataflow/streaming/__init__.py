from strataflow.streaming.ingest import file_stream, ingest_once, ingest_rejects, landing_stream, load_table_once

__all__ = ["file_stream", "ingest_once", "ingest_rejects", "landing_stream", "load_table_once"]
