"""All queries of this subpackage."""

from stayline.llm import (  # noqa: F401
    dart_minhash,
    fingerprints,
    html_model,
    learned_partitions,
    line_dedup,
    mixing,
    periodic_runs,
    quality,
    sentencepiece_fst,
    substring_dedup,
    token_alignment,
    token_files,
    warc,
)
from stayline.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
