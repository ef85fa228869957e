"""Settings: defaults, profile files laid over one another, environment, explicit values."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

#: Fixed term lists of the default profile.
CONDITIONS = (
    "chronic coronary disease", "coronary artery disease", "familial hypercholesterolemia", "myocardial infarction", "heart failure",
    "hypertrophic cardiomyopathy", "atrial fibrillation", "hypertension", "peripheral artery disease", "congenital heart disease",
)
BIOMARKERS = ("ldl-c", "ldl cholesterol", "hs-crp", "troponin", "bnp", "nt-probnp", "apolipoprotein b", "lipoprotein(a)", "blood pressure")
DRUGS = (
    "statin", "ezetimibe", "pcsk9 inhibitor", "aspirin", "anticoagulation", "beta-blocker", "ace inhibitor", "arb", "antiplatelet therapy", "gene counseling",
)
PREFIX = "LOOMGRAPH_"


@dataclass(frozen=True)
class Settings:
    input_glob: str = "data/raw/*.json"
    pdf_folder: str = "data/source_pdfs"
    work_folder: str = "data/processed"
    family: str = "aha"
    chunk_size: int = 1600
    chunk_overlap: int = 200
    top_k: int = 5
    extractor: str = "heuristic"
    backend: str = "files"
    build_index: bool = True
    gene_lexicon: str | None = None
    conditions: tuple[str, ...] = field(default=CONDITIONS)
    biomarkers: tuple[str, ...] = field(default=BIOMARKERS)
    drugs: tuple[str, ...] = field(default=DRUGS)

    def at(self, *parts: str) -> str:
        return "/".join((self.work_folder.rstrip("/"), *parts))


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` laid over ``base``, dicts key by key."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def read_profile(path: Path) -> dict:
    """A JSON profile, or a YAML one where a YAML reader is installed. No file: empty."""
    if not path.exists():
        return {}
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def find_root(start: Path | None = None, env: dict[str, str] | None = None, marker: str = "profiles") -> Path:
    """The folder that has a ``profiles`` folder: upwards from LOOMGRAPH_ROOT if that is set (which stands even without
    one), else from ``start``, the working folder or this package; else ``start`` or the working folder."""
    up = lambda at: next((p for p in (at, *at.parents) if (p / marker).is_dir()), None)
    named = (dict(os.environ) if env is None else env).get(PREFIX + "ROOT")
    if named:
        return up(Path(named).resolve()) or Path(named).resolve()
    starts = [p.resolve() for p in (start, Path.cwd(), Path(__file__)) if p is not None]
    return next((found for p in starts if (found := up(p))), starts[0])


def load_settings(profile: str | None = None, root: Path | None = None, env: dict[str, str] | None = None, **explicit: Any) -> Settings:
    """Defaults, then profile ``base``, the named profile, variables LOOMGRAPH_<NAME>, and explicit values."""
    env = dict(os.environ) if env is None else env
    root = find_root(root, env)
    found: dict = {}
    for name in ("base", profile):
        for suffix in (".json", ".yaml"):
            if name:
                found = deep_merge(found, read_profile(root / "profiles" / f"{name}{suffix}"))
    known = {f.name: f for f in fields(Settings)}
    for name, f in known.items():
        raw = env.get(PREFIX + name.upper())
        if raw is not None:
            kind = str(f.type)
            found[name] = int(raw) if kind == "int" else raw.lower() in ("1", "true", "yes") if kind == "bool" else tuple(x.strip() for x in raw.split(",")) if "tuple" in kind else raw
    found = deep_merge(found, {k: v for k, v in explicit.items() if v is not None})
    if unknown := set(found) - set(known):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})
