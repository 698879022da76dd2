from .catalog import Sources
from .adapter import domain_sources, read_driver
from .sink import publish

__all__ = ["Sources", "domain_sources", "read_driver", "publish"]
