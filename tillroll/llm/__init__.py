"""Training-data operators: tokenising, dedup, quality, extraction, scoring, search, packing.

Each module holds one general operator and the thin query the driver runs on
its table; ``llm.catalog`` lists the queries and their DuckDB SQL.  Nothing
else in the library imports this subpackage.
"""
