"""News analytics as Spark jobs: import, extract, clean, summarise, analyse, price upkeep."""

from pressroom.session import build_session, configure, work_dir
from pressroom.sources.tables import Warehouse

__all__ = ["Warehouse", "build_session", "configure", "work_dir"]
