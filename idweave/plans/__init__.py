"""Assembled jobs."""

from .identifiers import (DuplicateKeys, identifiers_historic, identifiers_same_day, publish_identifiers,
                          publish_same_day, run)
from .daily import publish_daily, publish_state, source_changes
from .inputs import Sources

__all__ = ["Sources", "DuplicateKeys", "identifiers_historic", "identifiers_same_day", "publish_identifiers",
           "publish_same_day", "run", "publish_state", "publish_daily", "source_changes"]
