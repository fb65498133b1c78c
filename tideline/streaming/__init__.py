"""Streaming forms of the operators.

Counts, time windows and sessions are Spark's own streaming aggregations (``forms``). Operators
that depend on arrival order keep keyed state (``processors``). Rules that all rows share, and
the split of late rows, work per micro-batch (``batches``).
"""
