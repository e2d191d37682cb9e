"""Operators that turn raw text and pages into training data."""

from ledgerline.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
