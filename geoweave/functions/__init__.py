"""Part of geoweave."""
