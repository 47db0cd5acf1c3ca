"""orderloom: e-commerce line items, refunds, ledgers and fees as Spark DataFrame jobs."""

__version__ = "0.1.0"
