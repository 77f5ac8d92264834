"""geoweave: gazetteer-to-document evidence engine and corpus tools on PySpark."""
