"""All queries of this subpackage."""

from paystrata.llm import conversations, decontaminate, huffman, langid, lm, neardup, negatives, packing, quality, secrets, sharding, substrings, template  # noqa: F401
from paystrata.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
