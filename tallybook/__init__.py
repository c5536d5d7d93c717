"""Ledger analytics as Spark DataFrame transformations.

``sources``    partitioned tables, landed JSON pages, budgets, balances
``functions``  column expressions (text, calendar, numbers)
``operators``  joins, dedup, rules, profiles, set operations
``plans``      whole pipelines: metric mart, quality checks, daily status
``streaming``  the change feed as a Structured Streaming job
"""
