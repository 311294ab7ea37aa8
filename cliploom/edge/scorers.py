"""The model-backed scorer kinds, over providers of what their networks put out.

A provider is the part that decodes and runs a network; it is registered by the user of this library. Sampling, the
arithmetic on what it puts out and the failures are here. A kind without its provider can't be started, which gives rows
of the reason ``scorer_init_failed``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd

from cliploom import edge
from cliploom.functions.kernels import AESTHETIC, TECHNICAL


class Branches(Protocol):
    """(technical, aesthetic) outputs of a quality network for a clip; either may be None."""

    def branches(self, path: str, options: dict[str, Any]) -> tuple[float | None, float | None]: ...


class Embeddings(Protocol):
    """Image embeddings of a clip's frames, and the linear head (weights, bias) over them."""

    def total(self, path: str) -> int: ...
    def embeddings(self, path: str, frames: Sequence[int]) -> np.ndarray: ...
    def head(self) -> tuple[np.ndarray, float]: ...


class Flows(Protocol):
    """Optical flow fields, (2, height, width) each, between frames and the ones after them."""

    def total(self, path: str) -> int: ...
    def flows(self, path: str, first: Sequence[int]) -> Sequence[np.ndarray]: ...


_providers: dict[str, Callable[[dict[str, Any]], Any]] = {}


def register_provider(kind: str, factory: Callable[[dict[str, Any]], Any]) -> None:
    """The provider of a kind (dover, laion_aes, unimatch_flow), made from the model's options once a worker."""
    _providers[kind] = factory
    edge.register_scorer(kind, _factory(kind, factory))


def uniform(total: int, wanted: int) -> list[int]:
    """``wanted`` frame numbers at even steps, all frames if there are no more."""
    if total <= 0 or wanted <= 0:
        return []
    return list(range(total)) if wanted >= total else [int(i * (total / wanted)) for i in range(wanted)]


def pairs(total: int, wanted: int) -> list[int]:
    """First frames of adjacent pairs spread over the clip."""
    n = max(wanted, 1)
    step = max(total // (n + 1), 1)
    return [i * step for i in range(n) if i * step + 1 < total] if total >= 2 else []


def fuse(technical: float | None, aesthetic: float | None, mode: str) -> float | None:
    """The branch of the mode or the first there is; ``fused`` scales both and maps their weighted sum to 0..1."""
    first = technical if technical is not None else aesthetic
    if mode == "technical" or technical is None or (mode == "aesthetic" and aesthetic is None):
        return first
    if mode == "aesthetic":
        return aesthetic
    if aesthetic is None:
        return technical
    (tm, ts, tw), (am, as_, aw) = TECHNICAL, AESTHETIC
    return float(1 / (1 + np.exp(-((technical - tm) / ts * tw + (aesthetic - am) / as_ * aw))))


class _Scorer:
    def __init__(self, kind: str, provider: Any, options: dict[str, Any]):
        self.kind, self.provider, self.options = kind, provider, options

    def one(self, path: str) -> float | None:
        p, o = self.provider, self.options
        if self.kind == "dover":
            return fuse(*p.branches(path, o), str(o.get("output", "fused")))
        if self.kind == "laion_aes":
            at = uniform(p.total(path), int(o.get("num_frames", 8)))
            if not at:
                return 0.0
            e = np.asarray(p.embeddings(path, at), dtype=np.float64)
            weights, bias = p.head()
            return float(np.mean(e / np.linalg.norm(e, axis=1, keepdims=True) @ np.asarray(weights) + bias))
        at = pairs(p.total(path), int(o.get("num_pairs", 3)))
        return float(np.mean([np.sqrt(f[0] ** 2 + f[1] ** 2).mean() for f in map(np.asarray, p.flows(path, at))])) if at else 0.0

    def score(self, records: pd.DataFrame) -> list[float | None]:
        out = []
        for path in records["video_path"]:
            try:
                out.append(self.one(path))
            except Exception:
                out.append(None)  # this clip's scoring error
        return out


def _factory(kind: str, make: Callable[[dict[str, Any]], Any] | None) -> edge.ScorerFactory:
    def factory(options: dict[str, Any]) -> edge.Scorer:
        if make is None:
            raise RuntimeError(f"no provider is registered for {kind}")
        return _Scorer(kind, make(options), options)

    return factory


for _kind in ("dover", "laion_aes", "unimatch_flow"):
    edge.register_scorer(_kind, _factory(_kind, None))
