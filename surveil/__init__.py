"""Disease-surveillance analytics as Spark DataFrame operators.

``functions``  column expressions (dates, null rules, text, rules)
``operators``  DataFrame to DataFrame steps (joins, aggregates, windows, reshape)
``sources``    readers and writers
``plans``      the report jobs composed from the above
"""
