"""Composed jobs: test-table adapter, batch pipeline, query registry, SQL oracles."""
