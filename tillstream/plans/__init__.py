"""Plans built from the operators: the fact table and the registered queries."""
