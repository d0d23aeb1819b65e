"""Operators of a training-data pipeline: mixing, filtering, deduplication,
language identification, tokenising, chat formatting and secret scans."""
