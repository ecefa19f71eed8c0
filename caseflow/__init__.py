"""caseflow - operational case analytics as plain PySpark DataFrame operators."""

from caseflow.plans.warehouse import Warehouse, warehouse

__all__ = ["Warehouse", "warehouse"]
