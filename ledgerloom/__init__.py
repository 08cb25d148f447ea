"""ledgerloom: a Spark-native trade ingestion and daily PnL engine.

Everything is expressed with DataFrame / SQL operators so Catalyst and AQE plan
the work; see README.md for the design notes.
"""

__version__ = "0.1.0"
