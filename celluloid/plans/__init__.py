"""Pipelines: bulk import, movie hydration, knowledge-base import and the run ledger."""
