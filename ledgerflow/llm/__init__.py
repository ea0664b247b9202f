"""Training-data operators: cleaning, deduplication, mixing and tokenising.

One module per operator; ``catalog`` holds the registered queries. Nothing
outside this subpackage imports it (``__spark_entry__.py`` adds its queries
only when it is there).
"""
