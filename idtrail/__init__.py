"""Identifier-mapping tables on Spark: classify, label, link and publish old-to-current ids."""
