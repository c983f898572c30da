"""Parameters as frozen dataclasses; unknown names raise. The defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureParams:
    kp_conf_thr: float = 0.3
    radius_face: float = 0.8
    radius_hand: float = 0.6
    radius_smoke: float = 1.5
    smoke_class: str = "smoke"


@dataclass(frozen=True)
class MotionParams:
    near_thr: float = 0.6
    far_thr: float = 1.0
    min_dwell_s: float = 0.3
    max_dwell_s: float = 5.0
    lookback_s: float = 3.0
    busy_window_s: float = 20.0
    busy_max_approaches: int = 4
    busy_penalty: float = 0.5
    smooth: int = 3


@dataclass(frozen=True)
class FusionParams:
    obj_thr: float = 0.35
    mot_thr: float = 0.50
    obj_strong: float = 0.75
    mot_strong: float = 0.95
    obj_percentile: float = 80.0


@dataclass(frozen=True)
class EventParams:
    n_on: int = 4
    k_on: int = 2
    m_off: int = 5


@dataclass(frozen=True)
class OnlineParams:
    """Frame counts of the online pipeline."""

    fps: float = 10.0
    window: int = 60
    hop: int = 10
    buffer: int = 200
    max_missing: int = 15

    @classmethod
    def from_seconds(cls, fps: float, window_s: float = 6, hop_s: float = 1, buffer_s: float = 20, max_missing_s: float = 1.5) -> OnlineParams:
        return cls(fps, *(max(1, round(s * fps)) for s in (window_s, hop_s, buffer_s)), round(max_missing_s * fps))
