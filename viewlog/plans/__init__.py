"""Composed plans: transform chains, the batch pipeline, the query registry and its oracles."""
