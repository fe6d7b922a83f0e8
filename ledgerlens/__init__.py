"""ledgerlens: subscription-contract and account analytics as Spark DataFrame operators.

Every public operator is a DataFrame-in, DataFrame-out function with an explicit
``as_of`` date.  The heavy lifting is left to Spark: filtered aggregates, joins on
the natural key ``(environment, accountcode)``, bounded windows and
``explode(sequence(...))`` grids, all visible to Catalyst.
"""

__all__ = ["operators", "sources", "functions", "plans"]
