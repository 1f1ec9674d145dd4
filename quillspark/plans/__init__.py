"""Whole runs: configuration, the chain from exports to the chunk table, and the registered queries."""
