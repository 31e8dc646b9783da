"""Where a project's tables, models and reports lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths below one root on shared storage; ``layout("processed", "train")`` is one of them."""

    root: str

    def __call__(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])
