"""DataFrame operators: recipes, batching, ledger, scheduling, tools, fetching and images."""
