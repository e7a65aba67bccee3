"""Column expressions used across the engine (all JVM-side built-ins)."""

from tidemark.functions.time import clamp_low, shift
from tidemark.functions.surrogate import account_surrogate, surrogate

__all__ = ["clamp_low", "shift", "surrogate", "account_surrogate"]
