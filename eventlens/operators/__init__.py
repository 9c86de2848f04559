"""DataFrame operators: parsing and routing, windowed aggregates, dedup,
derived fields and quality rules.  Each works unchanged on batch and
streaming DataFrames unless its docstring says otherwise."""
