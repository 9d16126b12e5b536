"""Training-data operators: filters, deduplication, tokenization, archives.

Each operator module holds a general interface (DataFrame in, DataFrame out);
``queries.py`` applies the ten operators to whole tables for the driver.
Nothing outside this package imports it.
"""
