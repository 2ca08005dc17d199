"""Sources (readers, schemas, ingest) and sinks."""

from .dictionary import code_dictionary
from .ingest import Source, ingest
from .readers import parse_csv_lines, read_csv, read_csv_checked, read_numbered_lines, read_parquet, read_text
from .sinks import write_bucketed, write_csv, write_parquet, write_text

__all__ = ["code_dictionary", "Source", "ingest", "parse_csv_lines", "read_csv", "read_csv_checked", "read_numbered_lines",
           "read_parquet", "read_text", "write_bucketed", "write_csv", "write_parquet", "write_text"]
