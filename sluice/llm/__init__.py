"""Training-data operators: one module per operator, plus shared helpers.

Nothing else in ``sluice`` imports this subpackage.  ``queries.py`` registers
the ``opN_*`` queries and the corpus pipeline.
"""
