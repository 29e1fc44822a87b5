"""Datasets, reports and registered queries, made of operators."""
