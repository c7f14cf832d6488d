"""DataFrame to DataFrame operators; each works on batch input, and on streams where noted."""
