"""Ledger operators: cleaning, marts, serving queries, quality checks, exploration."""
