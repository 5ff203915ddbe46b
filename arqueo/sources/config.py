"""Source configuration: what is to be landed, and which part of it a run is about."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    resource_type: str = "data"
    reference_year: int | None = None
    resource_name: str = ""
    page_url: str = ""
    download_url: str = ""
    resource_id: str = ""
    file_format: str = "csv"
    encoding: str = "utf-8-sig"
    mutable: bool = False


def parse_config(raw: object) -> list[SourceSpec]:
    """Sources of a parsed configuration: a mapping with ``project`` and a filled list ``sources``."""
    if not isinstance(raw, dict):
        raise ValueError("the configuration is not a mapping")
    for key in ("project", "sources"):
        if key not in raw:
            raise ValueError(f"the configuration has no {key!r}")
    if not isinstance(raw["sources"], list) or not raw["sources"]:
        raise ValueError("'sources' is not a list with entries")
    names = SourceSpec.__dataclass_fields__
    return [SourceSpec(**{k: v for k, v in s.items() if k in names}) for s in raw["sources"]]


def load_config(path: str | Path) -> list[SourceSpec]:
    """Read a YAML configuration; PyYAML is needed for that only."""
    import yaml

    return parse_config(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def select_sources(
    sources: list[SourceSpec], source_id: str | None = None, everything: bool = False,
    default: str | None = None, resource_type: str | None = None,
) -> list[SourceSpec]:
    """One source by id, all, or the default one; an unknown id names the choices."""
    pool = [s for s in sources if resource_type in (None, s.resource_type)]
    if everything:
        return pool
    wanted = source_id or default
    found = [s for s in pool if s.source_id == wanted]
    if not found:
        raise ValueError(f"unknown source {wanted!r}; known: {', '.join(s.source_id for s in pool)}")
    return found
