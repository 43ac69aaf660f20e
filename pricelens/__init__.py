"""pricelens: price intelligence on Spark.

``functions``  Column expressions (text, prices, quantities, relevance).
``operators``  DataFrame-in / DataFrame-out steps.
``sources``    schemas, readers, writers and the suggestion store.
``plans``      the full and the incremental run, built from the operators.
"""
