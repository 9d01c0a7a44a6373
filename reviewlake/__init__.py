"""reviewlake: review and event analytics as Spark DataFrame programs."""

from reviewlake.session import build_session, materialize

__all__ = ["build_session", "materialize"]
