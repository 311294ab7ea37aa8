"""Arithmetic on decoded frames, for providers and decoders that make frame features."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Weights of blue, green and red in brightness; mean and spread of red, green and blue network inputs.
LUMA = (0.114, 0.587, 0.299)
MEAN, SPREAD = (123.675, 116.28, 103.53), (58.395, 57.12, 57.375)


def mean_luma(frame: np.ndarray) -> float:
    """Mean brightness of a frame (height, width, blue-green-red); each pixel's is rounded to a whole number. 0 if empty."""
    frame = np.asarray(frame, dtype=np.float64)
    return float(np.floor(frame @ np.array(LUMA) + 0.5).mean()) if frame.size else 0.0


def luma_rows(path: str, frames: Iterable[np.ndarray], stride: int = 1) -> Iterator[tuple[str, int, float]]:
    """(path, frame_idx, mean_luma) of every ``stride``-th frame, as the flash filter takes them; frames aren't kept."""
    step = max(int(stride), 1)
    for i, frame in enumerate(frames):
        if i % step == 0:
            yield path, i, mean_luma(frame)


def clip_views(view: np.ndarray, clips: int = 1) -> np.ndarray:
    """A sampled view (red-green-blue, frames, height, width), standardised, as (clips, 3, frames of a clip, height, width)."""
    scaled = (np.asarray(view, dtype=np.float32) - np.array(MEAN, np.float32)[:, None, None, None]) / np.array(SPREAD, np.float32)[:, None, None, None]
    channels, total = scaled.shape[:2]
    if total % max(clips, 1):
        raise ValueError(f"{total} frames can't be divided into {clips} clips of equal length")
    return scaled.reshape(channels, max(clips, 1), -1, *scaled.shape[2:]).swapaxes(0, 1)
