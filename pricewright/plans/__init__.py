"""The weekly jobs and the registered queries."""
