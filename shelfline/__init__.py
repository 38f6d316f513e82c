"""shelfline: consumer-goods sales analytics, retrieval, memory and trace
operators expressed as Spark DataFrame jobs.

Every public operator takes DataFrames (or a session plus a table folder)
and returns a DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
