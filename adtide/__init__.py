"""Media-panel and ad-click analytics as Spark DataFrame operators."""
