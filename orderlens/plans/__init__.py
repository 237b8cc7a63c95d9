"""The analysis as a whole, the registered queries and their SQL counterparts."""
