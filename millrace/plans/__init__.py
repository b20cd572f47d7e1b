"""The five pipelines: sales, prices, web log, subscriptions, readings."""
