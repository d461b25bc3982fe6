"""Weekly retail demand forecasting and price optimisation as Spark DataFrame operators.

``functions``  column expressions (calendar, measures, price-index arithmetic)
``sources``    readers, writers and the model registry
``operators``  DataFrame-to-DataFrame steps
``plans``      the three weekly jobs and the registered queries
"""
