"""Medallion trip analytics written as Spark DataFrame jobs.

``sources``    raw, zone, registry and lake tables (read and write)
``functions``  reusable column expressions
``operators``  DataFrame -> DataFrame steps (align, clean, gate, marts, serving)
``plans``      whole jobs put together from the operators
"""
