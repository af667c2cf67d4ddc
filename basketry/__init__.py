"""Retail customer analytics and personal offers as PySpark DataFrame operators."""

from basketry.schema import Tables
from basketry.session import tune, tune_joins
from basketry.workspace import Workspace

__all__ = ["Tables", "Workspace", "tune", "tune_joins"]
