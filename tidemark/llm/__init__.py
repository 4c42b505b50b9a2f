"""Operators for preparing training text: mixing, classification, de-duplication,
extraction and filtering of document tables.

Nothing else in the library imports this package. Every operator is a function from
DataFrames to a DataFrame; ``queries.py`` registers one query per operator."""
