"""loanmart: relational credit-history features, preparation, rebalancing,
training and metrics expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
