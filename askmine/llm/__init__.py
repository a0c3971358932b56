"""Training-data operators: one module per operator, and the queries that apply them."""
