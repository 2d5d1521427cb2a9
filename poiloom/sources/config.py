"""Settings from a YAML file."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import yaml


@dataclass(frozen=True)
class Settings:
    country: str
    data_dir: str
    raw_data: str
    output_data: str
    #: Folder of pattern and keyword packs that aren't built in.
    packs: str | None = None


def load(path: str) -> Settings:
    """Paths are resolved against the file's folder; the country is put in lower case."""
    root = Path(path).resolve().parent
    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    own = found["paths"]
    where = {k: str(root / own[k]) for k in ("data_dir", "raw_data", "output_data")}
    packs = own.get("packs")
    return Settings(country=found["pipeline_settings"]["active_country"].lower(), packs=str(root / packs) if packs else None, **where)
