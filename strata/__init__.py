"""strata: Spark jobs over the sales star schema (region, nation, customer,
orders, lineitem) and over text corpora, checked against DuckDB SQL or brute force.

Layout:
    sources/    typed readers for the input tables
    functions/  column expressions (exact money arithmetic)
    plans/      the star-schema queries
    llm/        operators of a training-data pipeline (nothing else imports it)
"""

__version__ = "0.2.0"
