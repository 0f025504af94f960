"""Training-data operators: one module per operator, each over whole
tables and whole texts.  ``catalog`` registers their queries.  Nothing
outside this subpackage imports it except the guard in ``__spark_entry__``.
"""
