"""strata: a layered (bronze / silver / gold) analytics lakehouse on plain Apache Spark."""
