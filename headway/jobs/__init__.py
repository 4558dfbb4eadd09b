"""Command lines for spark-submit. Arguments in, plans called; no logic."""
