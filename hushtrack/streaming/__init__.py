"""Incremental processing: state is carried from run to run in the gaps table."""
