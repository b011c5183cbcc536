from keelson.sinks.tables import (append, ensure_table, insert_overwrite, overwrite_path,
                                  write_observed)

__all__ = ["append", "ensure_table", "insert_overwrite", "overwrite_path", "write_observed"]
