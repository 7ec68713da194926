"""Training-data operators: DataFrame operators and their queries.

Nothing else in the library imports this subpackage. Each operator lives in
its own module with a general interface; ``queries`` holds the thin
registered queries and their SQL.
"""
