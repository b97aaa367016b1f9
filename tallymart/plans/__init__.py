"""Jobs that combine the operators, and the registered queries."""
