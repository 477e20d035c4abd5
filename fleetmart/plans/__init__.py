"""Whole runs: the stages in gate order over one layout of paths."""
