"""DataFrame-to-DataFrame operators, lazy and without actions of their own."""
