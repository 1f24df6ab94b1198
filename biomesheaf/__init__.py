"""Metagenomic cohort analytics as PySpark DataFrame operators."""
