"""Imports every query module of this subpackage, so that its registry is complete."""

from shelfrank.llm import decontaminate, embedding_dedup, filter_audit, hard_negatives, line_dedup, near_dedup, packing, quality, secrets, sentencepiece, sharding, substring_dedup, toxicity  # noqa: F401
from shelfrank.llm.registry import ORACLES, QUERIES  # noqa: F401
