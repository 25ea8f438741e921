"""Rule-based text-sentiment analytics on Spark.

``process_files`` loads, chunks, scores and stores files; the functions in
``tonegrain.operators`` work on the stored chunk table.
"""

from tonegrain.functions.scoring import score_text, sentiment
from tonegrain.jobs import batch_stats, process_files, score_files
from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.records import chunk_records, line_records
from tonegrain.operators.search import export_rows, export_search, page, search, search_page, suggest
from tonegrain.sources.lines import read_chunks, read_lines

__all__ = [
    "DEFAULT_LEXICON", "Lexicon", "batch_stats", "chunk_records", "export_rows", "export_search", "line_records",
    "page", "process_files", "read_chunks", "read_lines", "score_files", "score_text", "search", "search_page",
    "sentiment", "suggest",
]
