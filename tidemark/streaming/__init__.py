"""Long-running jobs: keyed tables, maintained views, fan-out."""
