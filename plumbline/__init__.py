"""plumbline: data preparation, model quality and monitoring as Spark DataFrame operators."""
