"""Every operator as a query over the given tables, beside the SQL it must agree with."""

from partflow.catalogue.entries import CATALOGUE
from partflow.catalogue import documents, jobs, keyed, partitions, quality, reports  # noqa: F401,E402

__all__ = ["CATALOGUE"]
