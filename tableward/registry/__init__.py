"""Registered queries: each operator on the given tables, with its SQL counterpart."""

from tableward.registry.base import registered

__all__ = ["registered"]
