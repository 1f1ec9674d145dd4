"""Operators for the texts of a training corpus. Nothing else in the library imports this package."""

from __future__ import annotations

import importlib
import importlib.util

#: Modules with QUERIES (and SQL, where SQL can express the query), in the order of the problems.
NAMES = ["quotes", "scans", "mojibake", "pii", "packing", "leakage", "subjects"]


def modules() -> list:
    return [importlib.import_module(f"{__name__}.{n}") for n in NAMES if importlib.util.find_spec(f"{__name__}.{n}")]
