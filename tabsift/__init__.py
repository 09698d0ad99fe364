"""tabsift: checks, screening, drift, training, evaluation and scoring of
tabular classifier data as ordinary Spark DataFrame jobs."""

from tabsift.roles import Roles, Windows

__all__ = ["Roles", "Windows"]
