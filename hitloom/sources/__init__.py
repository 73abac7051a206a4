from hitloom.sources.fixtures import session_docs, session_docs_for
from hitloom.sources.raw import RAW_COLUMN, list_input_files, load_raw, raw_from_text, write_json_files
from hitloom.sources.tables import TABLES, table

__all__ = ["RAW_COLUMN", "TABLES", "list_input_files", "load_raw", "raw_from_text",
           "session_docs", "session_docs_for", "table", "write_json_files"]
