"""Model plans: staging views, facts and reconciliation built as lazy DataFrames."""
