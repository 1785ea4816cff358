"""Prompt templates: one text file for each model role."""

from __future__ import annotations

from importlib import resources


def template(role: str) -> str:
    return resources.files(__package__).joinpath(f"{role}.txt").read_text(encoding="utf-8").rstrip("\n")


def roles() -> list[str]:
    return sorted(f.name.removesuffix(".txt") for f in resources.files(__package__).iterdir() if f.name.endswith(".txt"))
