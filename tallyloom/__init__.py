"""Normalise wide questionnaire responses into narrow fact tables on Spark.

The package is organised by what a step does to a DataFrame:

``functions``  column expressions (keys, flags, numbers, terms, text)
``operators``  DataFrame -> DataFrame steps (unpivot, lookups, filters, upkeep)
``sources``    delivered files, lookup tables, sinks
``plans``      the stage schema and one builder per output table
``streaming``  incremental pick-up of newly delivered files
"""
