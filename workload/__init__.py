"""The driver's tables in chat form, the registered queries, and their SQL counterparts."""
