"""Analytics of governed contract and transaction data on Spark."""
