"""Composite plans: mart, summaries, studies, scoring, back-test."""
