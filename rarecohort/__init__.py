"""Cohort analytics for annotated genomic variants, on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame (or from Column to
Column).  Nothing here keeps session state, collects rows on the driver or
needs a Python UDF.
"""
