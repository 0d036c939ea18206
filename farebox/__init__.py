"""farebox: batch analytics over point-to-point trip records, on Spark.

Raw month files are cleaned in one lazy plan, written as a month-partitioned
table, rolled up into twenty insight tables in one scan, and queried with SQL.
"""
