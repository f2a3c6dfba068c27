"""Training-data operators: the corpus operators and their queries.

Nothing else in the library imports this subpackage; the entry module adds its
queries only when it can be imported.
"""
