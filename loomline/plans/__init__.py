"""End-to-end jobs composed of operators, and the registered queries."""
