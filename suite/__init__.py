"""Example tables, the registered queries over them, and their SQL counterparts."""
