"""Jobs composed of the operators, and the registered queries."""
