"""Jobs of the reference, composed from quarry operators, and the query
registry used by ``__spark_entry__``."""
