"""Operators of a training-data pipeline. Nothing else in the library imports this
subpackage; ``__spark_entry__.py`` adds its queries when it can be imported."""
