"""tidewatch: streaming credit monitoring and risk features as Spark DataFrame operators."""
