"""The analyses: operators put together over the tables, and the registered queries."""
