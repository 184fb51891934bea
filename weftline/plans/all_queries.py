"""Importing this registers every query of the library."""

from . import answer_queries, graph_queries, text_queries, upkeep_queries  # noqa: F401
from .catalog import ORACLE_SQL, QUERIES  # noqa: F401
