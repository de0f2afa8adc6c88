"""Jobs (compositions of operators) and the registered queries."""
