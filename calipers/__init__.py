"""Product-specification analytics as Spark jobs.

``functions``  Column -> Column expressions (text, media names, geometry)
``sources``    feeds, sinks and the views over the benchmark tables
``operators``  DataFrame -> DataFrame operators
``plans``      composite jobs and the registered queries
"""
