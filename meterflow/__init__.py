"""Metered-usage analytics as Spark DataFrame and SQL jobs.

``functions``  column expressions (amounts, time, hashing)
``operators``  DataFrame-to-DataFrame steps (energy, dedupe, billing, alerts, ...)
``sources``    reading and writing (records, stores, rate files, reports)
``streaming``  Structured Streaming jobs built from the same operators
``plans``      reports, audits and the query catalogue
"""
