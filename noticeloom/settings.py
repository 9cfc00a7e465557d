"""Settings: arguments before environment before a .env file before defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path


def _file(path: str | None) -> dict[str, str]:
    if not path or not Path(path).is_file():
        return {}
    lines = (line.strip() for line in Path(path).read_text(encoding="utf-8").splitlines())
    pairs = (line.removeprefix("export ").partition("=") for line in lines if line and not line.startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, _, v in pairs}


def load(defaults: Mapping, arguments: Mapping | None = None, environment: Mapping[str, str] | None = None, file: str | None = None, prefix: str = "NOTICELOOM_") -> dict:
    """`defaults`, a nested mapping, with what is set elsewhere. Names in the environment and the file are the prefix and the
    keys in capitals, joined by two underscores; an empty value counts as not set. Values take the type of their default;
    arguments are nested like the defaults, and null ones count as not set. Unknown arguments are an error."""
    environment = {**_file(file), **{k: v for k, v in (os.environ if environment is None else environment).items() if v != ""}}

    def typed(text: str, default):
        if isinstance(default, bool):
            return text.lower() in ("1", "true", "yes", "on")
        return type(default)(text) if default is not None else text

    def fill(defaults: Mapping, given: Mapping, name: str) -> dict:
        if unknown := set(given) - set(defaults):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        out = {}
        for key, default in defaults.items():
            place = f"{name}{key.upper()}"
            if isinstance(default, Mapping):
                out[key] = fill(default, given.get(key) or {}, f"{place}__")
            elif given.get(key) is not None:
                out[key] = given[key]
            else:
                out[key] = typed(environment[place], default) if environment.get(place) else default
        return out

    return fill(defaults, arguments or {}, prefix)
