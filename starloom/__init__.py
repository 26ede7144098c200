"""Star-schema batch loads on Spark: JSON activity logs and a JSON catalogue
become one fact table and four dimensions."""
