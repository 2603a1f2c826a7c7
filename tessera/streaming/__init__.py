"""Incremental runs: count tables kept up to date as caption files arrive."""
