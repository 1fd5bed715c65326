"""Benefits-screening analytics on Spark DataFrames."""

from screenmart.catalog import Catalog
from screenmart.session import get_session, tune

__all__ = ["Catalog", "get_session", "tune"]
