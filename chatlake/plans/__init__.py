"""Jobs that run the operators and store their results."""
