"""Inputs of the jobs: stored tables, derived inputs and sinks."""
