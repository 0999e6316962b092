"""histmart: a Spark-native history warehouse and fraud mart.

Change capture by high-water mark and key snapshot, slowly changing (type 2)
dimensions in one pass, typed fact loads with a quarantine, and three fraud
rules appended into one mart, all as DataFrame plans.
"""

__version__ = "0.1.0"
