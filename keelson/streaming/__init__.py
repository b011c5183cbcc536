from keelson.streaming.ingest import ingest_bronze

__all__ = ["ingest_bronze"]
