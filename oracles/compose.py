"""Put the named sub-queries a statement mentions in front of it as a WITH list."""

from __future__ import annotations

import re


def with_parts(parts: dict[str, str], body: str) -> str:
    """``parts`` are ordered: each may only mention earlier ones."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"[a-z_0-9]+", open_texts.pop()))
        for name in words & set(parts) - needed:
            needed.add(name)
            open_texts.append(parts[name])
    chosen = [f"{name} AS (\n{parts[name].strip()}\n)" for name in parts if name in needed]
    return (f"WITH {', '.join(chosen)}\n" if chosen else "") + body.strip()
