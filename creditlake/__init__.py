"""creditlake: credit-ledger analytics on Spark.

Raw credit actions → cleaned ``user_actions`` → dimensions → five marts →
serving queries and quality checks, all as DataFrame plans.
"""

__version__ = "0.1.0"
