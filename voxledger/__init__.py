"""Catalogue and process large volumetric image collections with Spark.

The package is a set of functions from DataFrames to DataFrames:

``sources``    record files, raw blobs, saved API responses, listings
``functions``  column helpers (globs, VARIANT lookups, arrays, text)
``operators``  validation, catalogue aggregates, record transforms, blocks, runs
``plans``      chunk grids, size classes and pyramid levels as column expressions
``streaming``  Structured Streaming forms of the status and access operators
``suite``      the registered queries over the test tables
"""
