"""Vacantia: a job-listing analytics engine written as Spark DataFrame programs."""

from vacantia.session import get_spark, shared_dir, stored

__all__ = ["get_spark", "shared_dir", "stored"]
