"""Issuer-rating announcements on Spark: extract, store, count, look up, report."""
