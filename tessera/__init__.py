"""tessera: localization and content-quality analytics as Spark DataFrame plans."""
