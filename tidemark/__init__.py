"""Document synchronisation, validation and planning as plain Spark queries."""
