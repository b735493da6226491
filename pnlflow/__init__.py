"""pnlflow: a customer-by-product P&L job as Spark DataFrame operators."""

from pnlflow.rules import JobParams, synthetic_params

__all__ = ["JobParams", "synthetic_params"]
