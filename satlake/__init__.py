"""Supply, bridge and reserve analytics expressed as Spark DataFrame jobs."""

from satlake.catalog import Catalog

__all__ = ["Catalog"]
