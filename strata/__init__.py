"""strata: a layered event warehouse (RAW -> STG -> ODS -> DM -> reports) as Spark DataFrame operators."""

__version__ = "0.1.0"
