"""Training-data operators: ten operators, each in its own module, with their queries."""
