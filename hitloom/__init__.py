"""hitloom: nested web-session analytics on Spark.

Raw JSON session documents -> typed compact table (keyed, content-hashed
upsert) -> fully exploded table -> seven session and e-commerce reports.
"""

__version__ = "0.1.0"
