"""Path handling shared by all readers and writers."""

from __future__ import annotations

import os
import re

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]+:/")


def to_uri(path: str) -> str:
    """Bare paths become absolute ``file://`` URIs; explicit schemes stay."""
    return path if _SCHEME.match(path) else "file://" + os.path.abspath(path)
