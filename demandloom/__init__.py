"""Spark-native retail demand-forecasting operators.

Everything here is a function from DataFrame(s) to a DataFrame, or a thin
reader / writer around one.  Catalyst sees the whole lineage; nothing in the
package pulls table-sized data to the driver or runs Python code per row.
"""

__version__ = "0.1.0"
