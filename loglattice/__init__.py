"""Log analytics on Spark: raw lines to events, layers, views, audits, models and written insights."""
