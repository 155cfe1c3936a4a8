"""Continuous forms of the incremental jobs; the checkpoint is the state."""
