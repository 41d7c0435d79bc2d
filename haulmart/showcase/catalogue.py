"""All registered queries."""

from haulmart.showcase import q_changes, q_etl, q_mining, q_reports, q_scalar
from haulmart.showcase.registry import QUERIES

__all__ = ["QUERIES", "q_changes", "q_etl", "q_mining", "q_reports", "q_scalar"]
