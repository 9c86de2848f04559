"""Operators for training-data pipelines: one module per operator, each a
plain DataFrame-in, DataFrame-out interface.  ``queries`` registers the thin
``opN_<name>`` queries over the given tables."""
