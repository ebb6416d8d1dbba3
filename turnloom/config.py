"""Settings: defaults, files, given values and the environment, the later before the earlier."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

#: Names that older configurations use, with the setting that each stands for.
LEGACY = {"LENGTH_GUARD_START": "length_guard_start", "LENGTH_GUARD_GAP": "length_guard_gap", "INTERRUPTION_GUARD_START": "floor_guard_start", "USE_LAST_N_HISTORY": "context_turns", "TARGET_LANGUAGE": "language"}


def merged(base: Mapping, over: Mapping) -> dict:
    """``base`` with the values of ``over``, mapping by mapping."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def dotted(tree: Mapping, path: str, default: object = None) -> object:
    """The value at ``a.b.c``, ``default`` where the path ends early."""
    at: object = tree
    for part in path.split("."):
        if not isinstance(at, Mapping) or part not in at:
            return default
        at = at[part]
    return at


def read_tree(path: str | Path) -> dict:
    """A configuration file: JSON, or YAML where its library is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ModuleNotFoundError as e:
        raise RuntimeError(f"{path} needs the yaml library; JSON does not") from e
    return yaml.safe_load(text) or {}


def legacy_view(env: Mapping[str, str]) -> dict[str, str]:
    """Settings under the names of older configurations."""
    return {new: env[old] for old, new in LEGACY.items() if old in env}


@dataclass(frozen=True)
class Settings:
    """What the engine can be told; every field may be set by TURNLOOM_<FIELD>."""

    seed: int = 42
    context_turns: int = 4
    length_guard_start: int = 0
    length_guard_gap: int = 4
    floor_guard_start: int = 3
    max_gap: int = 8
    fill_every: int = 4
    max_variants: int = 1
    train_ratio: float = 0.8
    gap_sec: float = 0.16
    pause_sec: float = 0.0
    language: str = "en"
    tokenizers: str = "/opt/tokenizers"

    @classmethod
    def load(cls, given: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None, files: tuple[str, ...] = ()) -> Settings:
        """Settings from files (their ``turnloom`` part, the later merged over the earlier), ``given``, older names and the environment; unknown keys are an error."""
        env = os.environ if env is None else env
        kinds = {f.name: type(f.default) for f in fields(cls)}
        tree: dict = {}
        for path in files:
            tree = merged(tree, read_tree(path))
        found = merged(dotted(tree, "turnloom", {}) or {}, given or {})
        if unknown := set(found) - set(kinds):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        found |= legacy_view(env)
        found |= {k: v for k in kinds if (v := env.get(f"TURNLOOM_{k.upper()}")) is not None}
        return cls(**{k: kinds[k](v) for k, v in found.items()})

    def guards(self) -> dict[str, int]:
        """The arguments of ``operators.slots.decided``."""
        return {"start_guard": self.length_guard_start, "floor_guard": self.floor_guard_start, "gap": self.length_guard_gap}

    def policy(self) -> dict[str, int]:
        """The arguments of ``operators.slots.slots_b``."""
        return {"max_gap": self.max_gap, "fill": self.fill_every}
