"""netpulse: network-telemetry analytics as Spark DataFrame transformations."""

from netpulse.config import EngineConfig
from netpulse.session import build_session, prepare

__all__ = ["EngineConfig", "build_session", "prepare"]
