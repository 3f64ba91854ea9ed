"""The registered queries once more, as SQL for an independent engine."""
