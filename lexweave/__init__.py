"""Spark-first analytics over case-law metadata, judgment trees and texts."""

__version__ = "0.1.0"
