"""Jobs composed of the operators, and the registry of the queries over the test tables."""
