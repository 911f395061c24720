"""mercato: sales reports and dataset diffs as Spark DataFrame operators."""

__version__ = "0.1.0"
