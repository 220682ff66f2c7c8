"""Queries by name: registry has them all once this package is imported."""

from . import consolidation, ingestions, ledger, more, registry, revisions, search  # noqa: F401
from . import extraction  # noqa: F401, E402  (its SQL holds that of more)
