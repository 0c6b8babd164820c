"""Open-data register, census and boundary processing as Spark DataFrame operators."""

from regista.session import build_session

__all__ = ["build_session"]
