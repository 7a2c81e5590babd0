"""Which code made a result."""

from __future__ import annotations

import os
from pathlib import Path


def head_commit(git: Path) -> str | None:
    """The commit that a git folder has checked out, read from its files."""
    try:
        head = (git / "HEAD").read_text().strip()
        if not head.startswith("ref: "):
            return head or None
        name = head.removeprefix("ref: ")
        if (git / name).exists():
            return (git / name).read_text().strip()
        packed = (git / "packed-refs").read_text().splitlines()
        return next((line.split()[0] for line in packed if line.endswith(f" {name}")), None)
    except OSError:
        return None


def code_version(root: Path = Path(__file__).resolve().parent.parent) -> str:
    """PAGEMILL_VERSION, else the file VERSION beside the package, else the commit, else ``unknown``."""
    if given := os.environ.get("PAGEMILL_VERSION"):
        return given
    file = root / "VERSION"
    return file.read_text().strip() if file.exists() else head_commit(root / ".git") or "unknown"
