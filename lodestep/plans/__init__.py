"""Runnable metric sets over the mapped tables, grouped by family.

Each module holds ``QUERIES``: name -> function of (spark, sf_dir) returning a DataFrame.
"""
