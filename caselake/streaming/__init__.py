"""Incremental work: resumption by processed keys, phases, latest status."""
