"""Training-data operators: scoring, filtering, matching, mixing, output.

Nothing else in the library imports this subpackage. Each module holds one
operator; :mod:`pulsegrid.llm.catalog` registers one query per operator.
"""
