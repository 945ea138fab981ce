"""All queries of this package: importing this module registers them."""

from loreweave.llm import bpe, exact_dedup, fim, hard_negatives, hilbert_ann, langid, mixing, pii, quality, simhash, token_files, toxicity, warc  # noqa: F401
from loreweave.llm.queries import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
