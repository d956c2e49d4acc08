"""leadsmith: table operators for entity acquisition, resolution, selection
and scoring, written as Spark DataFrame/SQL plans (see README.md)."""

__version__ = "0.1.0"
