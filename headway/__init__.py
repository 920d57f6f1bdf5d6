"""headway: transit and bike-share analytics on Spark (see README.md)."""
