"""Training-data operators: deduplication, decontamination, filters, mixing, records.

Nothing else in the library imports this subpackage. ``queries`` holds the registered
queries and their SQL.
"""
