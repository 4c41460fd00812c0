"""All queries of the workflows: importing this enters them."""

from __future__ import annotations

from . import alignments, catalog, curation, files, workflows  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
