"""Source registry, the inline peer list, and the test-table adapter."""

from .registry import Sources  # noqa: F401
