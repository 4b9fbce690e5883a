"""Incremental (file-arrival) execution of the daily pipeline."""
