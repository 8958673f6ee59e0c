"""Scalar column builders: keys, labels, buckets and stage predicates."""

from . import keys, predicates  # noqa: F401
