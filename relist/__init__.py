"""Listing normalisation, re-listing links and raw archiving as Spark jobs."""
