"""The jobs: bronze, silver, gold, and the chain of them."""
