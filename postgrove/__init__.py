"""postgrove: a PySpark-native analytics engine for job postings.

Everything is a function from DataFrames and Columns to DataFrames and Columns, parameterised by column
names.  ``functions`` holds Column expressions, ``operators`` DataFrame operators, ``sources`` readers and
writers, ``streaming`` the Structured Streaming forms, ``plans`` the registered queries with their SQL.
The optional subpackage ``llm`` holds the training-data operators; nothing outside it imports it.
"""

__version__ = "0.1.0"
