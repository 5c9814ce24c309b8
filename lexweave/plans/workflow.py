"""Workflows: steps named in YAML-like mappings, with variables, flattened and run once each."""

from __future__ import annotations

import os
import shutil
import time
from collections.abc import Callable, Mapping
from pathlib import Path

# What a server's parameters must name.
SERVER_KEYS = ("user", "password", "host", "folder", "build", "workflow")


def substitute(value: object, cli: Mapping[str, object] | None = None, config: Mapping[str, object] | None = None) -> object:
    """The value of ``$NAME``: environment, then command line, then configuration; falsy ones fall through."""
    if not isinstance(value, str) or not value.startswith("$"):
        return value
    name = value[1:]
    for found in (os.environ.get(name), (cli or {}).get(name.lower()), (config or {}).get(name)):
        if found:
            return found
    if name == "MAX_DOCUMENTS":
        return -1
    raise KeyError(f"{value} has no value")


def flatten(name: str, workflows: Mapping[str, list[tuple[str, str]]], actions: Mapping[str, object]) -> list[str]:
    """The actions of a workflow in order, each once, those of inner workflows in their place."""
    out: list[str] = []
    work = [("workflow", name)]
    open_: list[str] = []
    while work:
        kind, step = work.pop()
        if kind == "leave":
            open_.remove(step)
        elif kind == "workflow":
            if step not in workflows:
                raise KeyError(f"unknown workflow {step}")
            if step in open_:
                raise ValueError(f"workflow {step} holds itself")
            open_.append(step)
            work.append(("leave", step))
            work.extend((k, s) for s, k in reversed(workflows[step]))
        elif step not in actions:
            raise KeyError(f"unknown action {step}")
        elif step not in out:
            out.append(step)
    return out


def run(steps: list[str], actions: Mapping[str, Callable[..., object]], **shared: object) -> list[tuple[str, float, object]]:
    """Run steps in order: (name, seconds, result)."""
    out = []
    for step in steps:
        began = time.monotonic()
        result = actions[step](**shared)
        out.append((step, time.monotonic() - began, result))
    return out


def prepare_folder(path: str, mode: str = "strict") -> None:
    """A build folder: ``strict`` wants it absent, ``force`` empties it, ``update`` keeps what is there."""
    folder = Path(path)
    if folder.exists():
        if mode == "strict":
            raise FileExistsError(path)
        if mode == "force":
            shutil.rmtree(folder)
    folder.mkdir(parents=True, exist_ok=True)


def server_parameters(text: str) -> tuple[dict[str, str], list[str]]:
    """``k=v`` pairs between blanks, and the keys that are missing."""
    pairs = dict(p.split("=", 1) for p in text.split() if "=" in p)
    return pairs, [k for k in SERVER_KEYS if k not in pairs]


def duration(seconds: float, form: str = "{hours:02d}:{minutes:02d}:{seconds:02d}") -> str:
    whole = int(seconds)
    return form.format(days=whole // 86_400, hours=whole // 3600, minutes=whole // 60 % 60, seconds=whole % 60)
